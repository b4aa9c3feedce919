"""Deduces the templates of hosts from their pages and extracts the main texts.

The tokens are the structural elements of a page with their paths. In a path only
those words of classes, ids and roles are told apart that many of the host's pages
have, so that an id of the page's own changes no path. Tokens whose
occurrence vectors over the pages of a host are the same form an equivalence
class; classes that are large and frequent enough are valid. Paths nest them into
a template, in which the class that occurs once in every page is the outermost.
What is left between its tokens are the slots; the slot of the article is extracted.
Whether a token's text repeats on the host's pages tells a template's text.
Words are no tokens here, since the words of a passage that many articles share
can't be told from a template's.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.page_markup import folded, labels, named_noise, names_of, structure, text_of
from gapwise.llm.staging import spare, staged


SUMS = ("pages", "total", "low", "high", "chars", "with_text")
#: Elements that a slot may be.
CONTAINERS = {"body", "div", "section", "center", "table", "tbody", "tr", "td"}
#: Above any hash of texts.
NO_TEXT = 1 << 62
SLOTS = "host string, slot string, drop array<string>"


def host_of(url: Column) -> Column:
    """The host of an address in lower case; "" for null and for what isn't an address."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def with_host(pages: DataFrame) -> DataFrame:
    """host and html of `pages`."""
    return pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))


def known_names(pages: DataFrame, frequent: float = 0.5) -> DataFrame:
    """host, names: the words of classes, ids and roles that the share `frequent` of a host's pages or more has.

    All such words of a host are no more than a few of its pages have.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            found: Counter[tuple[str, str]] = Counter()
            for host, page in zip(got.column(0).to_pylist(), got.column(1)):
                found.update((host, name) for name in {"", *names_of(page.as_py() or "")})  # "" is the page itself
            if found:
                keys = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(keys[1]), pa.array(found.values(), pa.int64())], names=["host", "name", "pages"])

    counted = with_host(pages).mapInArrow(count, "host string, name string, pages long")
    met = staged(counted.groupBy("host", "name").agg(F.sum("pages").alias("pages")), "names")
    hosts = met.where("name = ''").select("host", F.col("pages").alias("n_pages"))
    often = F.when((F.col("name") != "") & (F.col("pages") >= frequent * F.col("n_pages")), F.col("name"))
    return met.join(hosts, "host").where(often.isNotNull() | (F.col("name") == "")).groupBy("host").agg(F.sort_array(F.collect_list(often)).alias("names"))


def occurrences(pages: DataFrame, names: DataFrame) -> DataFrame:
    """host, token, pages, total, low, high, chars and what tells repeating text: occurrence vectors as sums over the pages of a host.

    A page adds a hash of itself and of how often the token is in it. So tokens of
    equal vectors have equal sums, and the sums of any split of the pages add up.
    with_text are the pages on which a token holds text, least and most the extremes
    of their hashes of its distinct texts, seen a bit set of these pages' hashes.
    `names` has the words that paths tell apart.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from gapwise.llm.spans import mix

        for got in batches:
            found: dict[tuple[str, str], list[int]] = {}
            known: dict[str, frozenset[str]] = {}
            for at, (host, page) in enumerate(zip(got.column(0).to_pylist(), got.column(1))):
                page = page.as_py() or ""
                if host not in known:
                    known[host] = frozenset(got.column(2)[at].as_py() or ())
                own = structure(page, known[host])
                own[""] = (1, 0, None)  # the page itself
                name = np.uint64(hash_of(page))
                counts = np.array([n for n, _, _ in own.values()], np.uint64)
                vector = mix(name + counts * np.uint64(0x9E3779B97F4A7C15))
                low, high = (vector & np.uint64(0x7FFFFFFF)).tolist(), (vector >> np.uint64(33)).tolist()
                seen = 1 << int(mix(np.array([name]))[0] % np.uint64(62))
                for i, (token, (n, chars, texts)) in enumerate(own.items()):
                    row = found.setdefault((host, token), [0, 0, 0, 0, 0, 0, NO_TEXT, -1, 0])
                    for at, more in enumerate((1, n, low[i], high[i], chars)):
                        row[at] += more
                    if texts is not None:
                        row[5:] = row[5] + 1, min(row[6], texts), max(row[7], texts), row[8] | seen
            if found:
                keys, values = list(zip(*found)), np.array(list(found.values()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[0]), pa.array(keys[1]), *(pa.array(values[:, i]) for i in range(9))],
                    names=["host", "token", *SUMS, "least", "most", "seen"],
                )

    parts = with_host(pages).join(names, "host", "left").select("host", "html", "names").mapInArrow(
        count, f"host string, token string, {', '.join(f'{c} long' for c in (*SUMS, 'least', 'most', 'seen'))}"
    )
    rest = F.min("least").alias("least"), F.max("most").alias("most"), F.bit_or("seen").alias("seen")
    return parts.groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in SUMS), *rest)


def hash_of(page: str) -> int:
    import zlib

    raw = page.encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) << 32 | zlib.adler32(raw)


def templates(pages: DataFrame, frequent: float = 0.5, large: int = 3, repeats: int = 4, names: DataFrame | None = None) -> DataFrame:
    """host, n_pages, classes: the valid equivalence classes of each host, the most frequent first.

    A class has pages (in which it occurs), total, and its tokens (path, chars, whether
    the text is the same on all pages that have any, half of the token's and `repeats`
    different ones or more, and own, the chars of such text that it holds directly). It
    is valid if it occurs in at least the share `frequent` of the host's pages and has
    at least `large` tokens. `names` are the host's known names, found here if not given. A token that is frequent enough is in at least every
    so many pages, so a host has no more of them than a few pages have.
    """
    met = staged(occurrences(pages, known_names(pages, frequent) if names is None else names), "occurrences")
    hosts = met.where("token = ''").select("host", F.col("pages").alias("n_pages"))
    often = met.where("token != ''").join(hosts, "host").where(F.col("pages") >= frequent * F.col("n_pages"))
    same = (F.col("least") == F.col("most")) & (F.bit_count("seen") >= repeats) & (2 * F.col("with_text") >= F.col("pages"))
    # what an element holds directly goes with it, not into the classes' tokens
    direct = often.where("token like '%/'").select("host", F.expr("left(token, length(token) - 1)").alias("token"), F.when(same, F.col("chars")).alias("own"))
    often = often.where("token not like '%/'").withColumn("same", same).join(direct, ["host", "token"], "left")
    classes = often.groupBy("host", "n_pages", "pages", "total", "low", "high").agg(
        F.sort_array(F.collect_list(F.struct("token", "chars", "same", F.coalesce("own", F.lit(0)).alias("own")))).alias("tokens")
    )
    valid = classes.where(F.size("tokens") >= large)
    item = F.struct((-F.col("pages")).alias("order"), "total", "tokens")
    return valid.groupBy("host", "n_pages").agg(F.sort_array(F.collect_list(item)).alias("classes"))


def main_slot(classes: list[dict]) -> str | None:
    """The path of the template that holds the article: an article or main element, else the closest container of all text that varies.

    The classes nest by their paths, so a slot is what a token's element holds. From
    the body on, the slot is a container within if all other text around that is the
    same on the host's pages.
    """
    tokens = [(t["token"], t["chars"]) for c in classes for t in c["tokens"]]
    for wanted in ("article", "main"):
        own = [(chars, -labels(path), path) for path, chars in tokens if path.rpartition("/")[2].split(".")[0] == wanted]
        if own:
            return max(own)[2]
    once = {t["token"] for c in classes if c["total"] == -c["order"] for t in c["tokens"]}
    every = {t["token"]: t for c in classes for t in c["tokens"]}
    kids: dict[str, list[dict]] = {}
    for path, token in every.items():
        kids.setdefault(path.rpartition("/")[0], []).append(token)
    starts = [path for path in once if tag_of(path) == "body"] or [path for path in once if tag_of(path) == "html"]
    slot = max(starts, key=lambda path: (every[path]["chars"], path), default=None)
    while slot:
        own = kids.get(folded(slot), [])
        inner = [t for t in own if t["token"] in once and tag_of(t["token"]) in CONTAINERS and t["chars"] and not t["same"]]
        if not inner:
            break
        best = max(inner, key=lambda t: (t["chars"], t["token"]))
        others = sum(t["chars"] for t in own if t["same"])
        if every[slot]["chars"] - every[slot]["own"] - others > best["chars"]:
            break  # text around it varies
        slot = best["token"]
    return slot


def tag_of(path: str) -> str:
    return path.rpartition("/")[2].split(".")[0]


def repeating(classes: list[dict], slot: str | None) -> frozenset[str]:
    """The paths of a template's text, left out in `slot`: the same on the host's pages, and named by a noise word or, without an article, a container."""
    article = slot is not None and tag_of(slot) in ("article", "main")
    paths = [t["token"] for c in classes for t in c["tokens"] if t["same"]]
    return frozenset(path for path in paths if named_noise(path) or not article and tag_of(path) in ("div", "section", "table"))


def slots(found: DataFrame) -> DataFrame:
    """host, slot, drop of `templates`: where the article is, and the paths that are left out in it."""

    def deduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            classes = [own.as_py() for own in got.column(1)]
            slot = [main_slot(own) for own in classes]
            drop = [sorted(repeating(own, at)) if at else [] for own, at in zip(classes, slot)]
            columns = [got.column(0), pa.array(slot, pa.string()), pa.array(drop, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "slot", "drop"])

    return found.select("host", "classes").mapInArrow(deduce, SLOTS)


def extract_main_text(pages: DataFrame, frequent: float = 0.5, large: int = 3, repeats: int = 4) -> DataFrame:
    """`pages` with `text`, the main text of `html`, and `n_chars`, its code points.

    A page that lacks the slot of its host's template, or whose host has none, gives
    the text of its whole body; menus, headers, footers, sidebars, notices, adverts,
    forms, scripts, styles and reader comments never count. In the slot they are told
    by tag, by whole class tokens, or by a noise word and a text that repeats, which
    takes `repeats` different pages of a host. Null html is empty and gives an empty
    text. All rows and other columns stay; columns that have the names `text` and
    `n_chars` are replaced.
    """
    names = staged(known_names(pages, frequent), "known-names")
    found = slots(templates(pages, frequent, large, repeats, names)).where("slot is not null").join(names, "host")
    found = staged(found, "templates")
    host, known = (spare(name, pages.columns) for name in ("host", "template"))
    same = found.select(F.col("host").alias(host), F.struct("slot", "drop", "names").alias(known))
    joined = pages.drop("text", "n_chars").withColumn(host, host_of(F.col("url"))).join(same, host, "left")
    text = _extracted()(F.col("html").cast("string"), host, known)
    return joined.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).drop(host, known)


def _extracted():
    @F.arrow_udf("string")
    def extracted(pages: pa.Array, hosts: pa.Array, templates: pa.Array) -> pa.Array:
        known: dict[str, tuple[str | None, frozenset[str], frozenset[str]]] = {}
        out = []
        for i, (page, host) in enumerate(zip(pages, hosts.to_pylist())):
            if host not in known:
                own = templates[i].as_py() or {}
                known[host] = own.get("slot"), frozenset(own.get("drop") or ()), frozenset(own.get("names") or ())
            page = page.as_py() or ""
            slot, drop, names = known[host]
            text = text_of(page, slot, drop, names) if slot else None
            out.append(text_of(page, None) if text is None else text)
        return pa.array(out, pa.string())

    return extracted
