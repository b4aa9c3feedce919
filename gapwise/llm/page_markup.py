"""Reads markup: structural tokens of a page, and the text of its parts."""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")

#: Elements whose content isn't markup.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
#: Elements without an end.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that begin and end a block of text.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that aren't part of an article.
NOISE_TAGS = set(
    "nav header footer aside form script style title head menu noscript iframe template svg button select textarea input label dialog object canvas".split()
)
#: Words in a class, id or role that tell the same of any other element.
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert popup modal"
    " nav navbar navigation menu breadcrumb breadcrumbs header masthead footer contentinfo sidebar complementary aside widget related"
    " comment comments reply replies discussion disqus share sharing social newsletter subscribe subscription signup login search form".split()
)
#: Words beside which a noise word still makes a whole class token or id noise ("cookie-notice", not "social-history").
FILLERS = set(
    "left right top bottom main site page post posts list box bar wrap wrapper container inner outer block section area item items link links"
    " button buttons btn icon icons panel thread count title global primary secondary mobile slot unit".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: What walk() yields for a part that begins or ends and for a line break; no text equals them.
OPEN, CLOSE, BREAK = 1, 2, 3
#: Elements that hold the article or the whole page, whatever their class.
HOLDERS = {"html", "body", "article", "main"}
#: Characters of a path beyond which a hash stands for it in the paths below, so that deep nesting takes linear memory.
FOLD = 200


class Part:
    """An open element: its name with what tells it from others of the name, and whether it is noise.

    `sure` tells noise by the tag or a whole class token. Outside an article any word
    of a class, id or role makes `noise` too; inside, anchors and sections are named
    after what they are about. Words of a class, id or role that aren't among `names`
    (None: all) are one "*" in the path.
    """

    __slots__ = ("tag", "path", "key", "sure", "noise", "inside", "link", "above")

    def __init__(self, tag: str, attributes: str, above: Part | None, names: frozenset[str] | None = None):
        label, sure, word = escaped(tag).replace(".", "%2e"), tag in NOISE_TAGS, False
        for m in _NAMES.finditer(attributes) if attributes else ():
            value = (m[2] or m[3] or m[4] or "").lower()
            tokens = value.split()
            if names is not None and not names.issuperset(tokens):
                tokens = [token for token in tokens if token in names] + ["*"]
            label += f".{escaped(' '.join(tokens))}"
            if tag not in HOLDERS and not NOISE_WORDS.isdisjoint(_WORDS.findall(value)):
                name = m[1].lower()
                sure = sure or any(_known(tag, name, token) for token in value.split())
                word = word or tag not in HEADINGS or name != "id"
        self.tag, self.above = tag, above
        self.path = f"{above.key}/{label}" if above else label
        self.key = folded(self.path)
        self.inside = tag in ("article", "main") or bool(above and above.inside)
        self.sure = sure or bool(above and above.sure)
        self.noise = self.sure or word and not self.inside or bool(above and above.noise)
        self.link = tag == "a" or bool(above and above.link)


def _known(tag: str, name: str, token: str) -> bool:
    """Whether a whole token of the attribute `name` is one of known noise."""
    words = set(_WORDS.findall(token))
    own = words & NOISE_WORDS - {"discussion"}
    if name == "id":
        if tag not in ("div", "ul", "ol", "table", "section"):
            return False
        if tag == "section":  # reader comments only
            own &= {"comment", "comments", "disqus"}
    return bool(own) and words <= (own if tag in HEADINGS else own | FILLERS)


def named_noise(path: str) -> bool:
    """Whether the last label of `path`, of no heading, has a noise word in its class, id or role."""
    tag, _, names = path.rpartition("/")[2].partition(".")
    return tag not in HEADINGS and tag not in HOLDERS and not NOISE_WORDS.isdisjoint(_WORDS.findall(names))


def escaped(name: str) -> str:
    """`name` without the slash, which separates the labels of a path."""
    return name.replace("%", "%25").replace("/", "%2f")


def folded(path: str) -> str:
    """What stands for `path` before the labels of elements within: itself, or if it is long its number of labels and a hash."""
    if len(path) <= FOLD:
        return path
    return f"~{labels(path)}~{hashlib.blake2b(path.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


def labels(path: str) -> int:
    """How many labels `path` has, those that a hash stands for too."""
    return path.count("/") + (int(path[1 : path.index("~", 1)]) if path.startswith("~") else 1)


def names_of(page: str) -> set[str]:
    """The words of all classes, ids and roles of a page."""
    found: set[str] = set()
    for m in _TAG.finditer(page):
        for name in _NAMES.finditer(m[3]) if m[3] else ():
            found.update((name[2] or name[3] or name[4] or "").lower().split())
    return found


def walk(page: str, names: frozenset[str] | None = None) -> Iterator[tuple[str | int, Part | None]]:
    """(OPEN or CLOSE, part) for each structural element, (BREAK, _) at line breaks, and (text, innermost part).

    Only blocks have paths of their own; other elements count as part of their
    block, so that an unclosed <b> changes nothing. A block ends an open paragraph,
    and an end tag everything within. A text is raw: entities are not decoded.
    """
    stack: list[Part] = []
    opened: dict[str, int] = {}  # of the stack, by tag

    def close(down_to: int) -> Iterator[tuple[int, Part]]:
        while len(stack) > down_to:
            opened[stack[-1].tag] -= 1
            yield CLOSE, stack.pop()

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        start = m.start() if m else end
        if start > at:
            yield page[at:start], (stack[-1] if stack else None)
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if opened.get(tag):
                yield from close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        if tag in RAW:
            tail = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = page.find(">", tail.end()) + 1 if tail else 0
            at = at or end  # what isn't closed goes on to the end
            continue
        if tag in VOID:
            yield BREAK, None
            continue
        is_block = tag in BLOCKS or tag in NOISE_TAGS
        if not is_block:
            noisy = Part(tag, m[3], stack[-1] if stack else None, names)
            if not noisy.noise or stack and stack[-1].noise:
                continue  # of its block
            is_block = True
        if tag in BLOCKS and stack and stack[-1].tag == "p":
            yield from close(len(stack) - 1)
        if tag in ("li", "dt", "dd", "tr", "td", "th") and stack and stack[-1].tag == tag:
            yield from close(len(stack) - 1)
        stack.append(Part(tag, m[3], stack[-1] if stack else None, names))
        opened[tag] = opened.get(tag, 0) + 1
        yield OPEN, stack[-1]
    yield from close(0)


def structure(page: str, names: frozenset[str] | None = None) -> dict[str, tuple[int, int, int | None]]:
    """For each path of a page: how often it opens, the characters of its texts outside noise, and the sum of hashes of its distinct texts outside sure noise (None: it has none).

    A path that ends in "/" stands for the texts that an element holds directly.
    """
    opened: dict[str, int] = {}
    above: dict[str, str | None] = {}  # a path comes behind that of its parent
    chars: dict[str, int] = {}
    texts: dict[str, set[int]] = {}
    for what, part in walk(page, names):
        if part is None or what == CLOSE:
            continue
        if what == OPEN:
            opened[part.path] = opened.get(part.path, 0) + 1
            above[part.path] = part.above.path if part.above else None
        elif not part.sure and (what := what.strip()):
            direct = f"{part.path}/"
            opened[direct] = 1
            chars[direct] = chars.get(direct, 0) + (0 if part.noise else len(what))
            texts.setdefault(direct, set()).add(zlib.crc32(what.encode("utf-8", "surrogatepass")))
    sums = {path: sum(own) for path, own in texts.items()}
    for path in reversed(above):  # text counts for all that hold it
        _add(path, f"{path}/", chars, texts, sums)
        if outer := above[path]:
            _add(outer, path, chars, texts, sums)
    return {path: (n, chars.get(path, 0), sums.get(path)) for path, n in opened.items()}


def _add(to: str, path: str, chars: dict[str, int], texts: dict[str, set[int]], sums: dict[str, int]) -> None:
    """Adds what `path` holds to `to`; its set is used up, and the smaller set goes into the larger one."""
    if path not in texts:
        return
    chars[to] = chars.get(to, 0) + chars[path]
    small, total = texts.pop(path), sums[path]
    large = texts.get(to, set())
    if len(large) < len(small):
        small, large = large, small
    else:
        total = sums.get(to, 0)
    texts[to], sums[to] = large, total + sum(small - large)
    large |= small


def text_of(page: str, within: str | None, drop: frozenset[str] = frozenset(), names: frozenset[str] | None = None) -> str | None:
    """The text outside noise of all elements with the path `within` (None: the page); None if there is no such element.

    In a closer element than the body only sure noise counts. Elements in it with a path in
    `drop` are left out. Blocks are joined by a line feed; in a block, white space is one space.
    """
    blocks: list[str] = []
    held: list[str] = []
    depth = 0 if within else 1
    met = not within
    close = bool(within) and within.rpartition("/")[2].split(".")[0] not in ("html", "body")
    dropped = 0

    def flush() -> None:
        block = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if block:
            blocks.append(block)

    for what, part in walk(page, names):
        if what == OPEN or what == CLOSE:
            if part.sure or not close or part.tag in BLOCKS:
                flush()
            step = 1 if what == OPEN else -1
            if part.path == within:
                depth, met = depth + step, True
            elif depth:
                dropped += step * (part.path in drop)
        elif depth and not dropped and not (part and (part.sure if close else part.noise)):
            held.append(" " if what == BREAK else what)
    flush()
    return "\n".join(blocks) if met else None
