import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gapwise.llm.chat import Template, formatted, read_back, segments
from gapwise.llm.page_markup import BREAK, CLOSE, OPEN, structure, text_of, walk
from gapwise.llm.personal_data import masked, with_personal_data
from gapwise.llm.templates import extract_main_text, templates

BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def confirmed(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute_spans(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE) for m in re.finditer(p, text) if confirmed(k, m[0])]
    return sorted(found)


PARTS = [
    "a", "b", "@", ".", "-", "+", "_", "1", "2", "25", "4111111111111111", "4111 1111 1111 1111", " ", "(", ")", "é", "\U0001f600",
    "192.168.0.1", "x@y.de", "DE89370400440532013000", "\n", "+49 30 1234567", "0", "..", "iban ", "123-45-6789", "ssn "
]


def test_spans_are_those_of_the_plain_patterns(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choice(PARTS) for _ in range(r.randint(0, 40)))) for i in range(2000)]
    rows += [(-1, None), (-2, ""), (-3, "x@y.de " * 5000), (-3, "x@y.de " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS kind").repartition(8)
    found = with_personal_data(docs)
    masks = found.withColumn("masked", masked(F.coalesce("text", F.lit("")), F.col("personal_data"))).collect()
    assert len(masks) == len(rows)
    for row in masks:
        text, done, out = row.text or "", 0, []
        assert [(s.start, s.rank, s.end, s.kind) for s in row.personal_data if s.base] == brute_spans(text)
        for s in row.personal_data:
            if s.start >= done:
                out += [text[done : s.start], f"[{s.kind.upper()}]"]
            done = max(done, s.end)
        assert row.masked == "".join(out) + text[done:]
    assert {s.kind for row in masks for s in row.personal_data} == {"email", "ip", "card", "phone", "iban", "ssn"}


def test_checksums_and_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00.", "DE88370400440532013000", "my ssn is 123-45-6789", "123-45-6789", "card 4111111111111111", "4111111111111111"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, round(s.score, 2)) for s in r.personal_data] for r in with_personal_data(docs).collect()}
    assert found == {0: [("iban", 1.0)], 1: [], 2: [("ssn", 0.8)], 3: [], 4: [("card", 0.9)], 5: [("card", 0.7)]}


def test_hostile_long_texts_take_linear_time(spark):
    rows = [(0, "a." * 300_000), (1, "1 " * 200_000), (2, "+1 " * 100_000), (3, "1." * 200_000), (4, "9" * 500_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert with_personal_data(docs.repartition(5)).select(F.sum(F.size("personal_data"))).first()[0] == 50_000


def test_conversations_come_back_whole(spark):
    r = random.Random(1)
    parts = ["<", "\\", "/", "s>", "[", "INST]", "SYS>>", "t|", "ROLE ", "ROLE]", " ", "x", "é\U0001f600", "\n", "</s>", "<t|", "<<"]
    roles = ["user", "assistant", "system", "tool<t|x>", "", None]
    rows = [(c, i, r.choice(roles), "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for c in range(400) for i in range(r.randint(1, 6))]
    rows += [(None, 1, "user", "a"), (7777, None, None, None), (8888, 0, "user", "x" * 50_000)]
    rows += [(9999, i, "assistant" if i % 2 else "user", "hé " * 20) for i in range(3000)]
    rows += [(5555, 1, "user", "b"), (5555, 1, "user", "a"), (5555, 1, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS block", "2 AS place")
    whole = formatted(segments(turns))
    want = {}
    for c, t, role, text in sorted(rows, key=lambda x: (x[0] or -9, -1 if x[1] is None else x[1], x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    for row in read_back(whole).collect():
        assert [(t.role, t.text) for t in row.turns] == want.pop(row.conv_id)
        assert list(row.loss_texts) == [t.text for t in row.turns if t.role == "assistant"]
    assert not want
    assert whole.where("conv_id = 9999").first().valid
    assert segments(turns.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("roles", "valid"),
    [("ua", True), ("sua", True), ("u", False), ("au", False), ("uua", False), ("usa", False), ("uaua", True), ("s", False), ("", None)],
)
def test_role_machine(spark, roles, valid):
    names = {"u": "user", "a": "assistant", "s": "system"}
    rows = [(1, i, names[x], "t") for i, x in enumerate(roles)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    # blocks of one turn: the machine goes on over their borders
    found = formatted(segments(turns, Template(), block=1)).collect()
    assert [r.valid for r in found] == ([] if valid is None else [valid])


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></ul></nav>'
    '<!-- ad --><div class="ad">Buy</div><div class="cookie-notice">We use cookies</div><header>Site</header><article><h1>Head &amp; more</h1>'
    '<p><b>One  two<br>three<p class="x">&eacute;&#x41; &am</p><script>1<2</script><aside>Side</aside><ul><li>a<li>b</ul>'
    '<form><p>Mail</p></form></article><section id="comments"><p>Nice!</p></section><footer>&copy; x</footer></body></html>'
)


def test_main_text_of_a_page():
    want = "Head & more\nOne two three\néA &am\na\nb"
    assert text_of(PAGE, None) == want
    assert text_of(PAGE, "html/body/article") == want
    assert text_of(PAGE, "html/body/main") is None
    assert text_of(PAGE[: PAGE.index("</article>")], "html/body/article") == want
    assert text_of("", None) == "" and text_of("plain < text", None) == "plain < text"


def test_page_content_is_no_marker_of_the_walk(spark):
    page = (
        '<body><article><div class="md:w-1/2" id="a/b%2f"><p>it was <em>open</em> all day</p><p>close</p>open<br>break</div>'
        "<article>close<p>last</p></article></article>break</body>"
    )
    want = "it was open all day\nclose\nopen break\nclose\nlast"
    assert text_of(page, "body/article") == want
    assert text_of(page, None) == f"{want}\nbreak"
    assert structure(page)["body/article/div.md:w-1%2f2.a%2fb%252f/p"][0] == 2
    pages = spark.createDataFrame([(1, "http://a.example/", page)], "page_id long, url string, html string")
    assert extract_main_text(pages).first().text == want


def test_sections_of_an_article_are_no_noise_by_their_names(spark):
    inner = (
        '<h2 id="search-results">Results {0}</h2><h2 id="related-work">Related {0}</h2><h3 id="how-to-share-a-form">Share {0}</h3>'
        '<section id="discussion"><p>Talk <span class="social-history">of</span> {0}</p></section><div class="social-history"><p>History {0}</p></div>'
        '<div class="story-share-x"><p>Same on all</p></div><div class="note cookie-notice">We {0}</div><ul class="menu"><li>{0}</ul><div id="comments">Nice {0}</div>'
    )
    page = "<html><body><div class='search-x'>no {0}</div><article>" + inner + "</article></body></html>"
    want = "Results {0}\nRelated {0}\nShare {0}\nTalk of {0}\nHistory {0}"
    assert text_of(page.format(1), "html/body/article") == want.format(1) + "\nSame on all"
    assert text_of(page.format(1), None) == want.format(1) + "\nSame on all"
    rows = [(i, "http://a.example/", page.format(i)) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in extract_main_text(pages).collect()} == {i: want.format(i) for i in range(20)}


@pytest.mark.parametrize("wrap", [False, True])
def test_text_around_the_largest_container_stays(spark, wrap):
    post = '<div class="post"><h1>Title {0}</h1><p>Lead {0}</p><div class="body"><p>{1}</p><p>Always</p></div><div class="credits">Site text</div></div>'
    outside = '<div class="top"><p>Same site</p></div>{2}<div class="bottom">Imprint</div>'
    page = "<html><body>" + ('<div class="page">' + outside + "</div>" if wrap else outside) + "</body></html>"
    pages = [(i, "http://a.example/", page.replace("{2}", post.format(i, f"body {i} " * (100 if i % 5 else 1)))) for i in range(20)]
    found = extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    want = {i: f"Title {i}\nLead {i}\n{(f'body {i} ' * (100 if i % 5 else 1)).strip()}\nAlways" for i in range(20)}
    assert {r.page_id: r.text for r in found} == want


def test_templates_by_equal_occurrences(spark):
    page = lambda i, inner: f'<html><body><div class="top">{"<p>n</p>" * i}</div><div class="text"><p>{inner}</p></div></body></html>'
    rows = [(i, "http://a.example/x", page(i % 3, f"long text number {i} " * 5)) for i in range(12)]
    rows += [(20, "http://b.example/", "<main><p>only</p></main>"), (21, None, None), (22, "no address", ""), (23, "HTTP://A.example", "<p>other</p>")]
    rows += [(0, "http://a.example/x", rows[0][2])] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'old' AS text", "1 AS host", "2 AS token")
    classes = {r.host: r for r in templates(pages).collect()}["a.example"].classes
    first = {t.token for t in classes[0].tokens}
    assert {"html", "html/body", "html/body/div.text", "html/body/div.top"} <= first
    found = extract_main_text(pages).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert texts[5] == " ".join(["long text number 5"] * 5) and texts[20] == "only" and texts[21] == texts[22] == "" and texts[23] == "other"
    assert all(r.n_chars == len(r.text) for r in found)
    assert extract_main_text(pages.limit(0)).count() == 0


def test_queries_digest_what_the_operators_find(spark):
    from gapwise.llm.queries import QUERIES

    found = QUERIES["op8_chat_formatting"](spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert (found.n_turns, found.loss_chars) == (2, len(said))
    assert found.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_pages_of_very_many_raw_elements_and_unclosed_ones():
    many = "<article>" + "<script>var a = '<p>no';</SCRIPT ><p>t</p>" * 10_000 + "</article>"
    assert text_of(many, None).split("\n") == ["t"] * 10_000
    assert text_of("<article><p>a</p><style>p {} </style<p>b", None) == "a\nb"
    assert text_of("<article><p>a</p><script>b </scriptx><p>c", None) == "a"


def test_pages_of_very_deep_elements_take_linear_time_and_memory():
    import tracemalloc

    def deep(n):
        return "<body>" + "".join(f'<div class="level{i}">{i} ' for i in range(n)) + "</p></span>" * n + "</div>" * n + "</body>"

    def peak(n):
        tracemalloc.start()
        found = structure(deep(n))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found["body"] == (1, sum(len(str(i)) for i in range(n)), found["body"][2])
        return most

    assert peak(16_000) < 10 * peak(2_000)
    assert text_of(deep(100_000), None).split("\n") == [str(i) for i in range(100_000)]


def test_structure_is_that_of_whole_paths(spark):
    r = random.Random(5)
    for _ in range(300):
        tags = [r.choice(["div", "p", "section", "li", "nav", "td"]) for _ in range(6)]
        parts = ["<{0}>", '<{0} class="a b{1}">', "</{0}>", "word{1}", "same", '<{0} id="long-{1}' + "x" * 60 + '">']
        page = "<body>" + "".join(r.choice(parts).format(r.choice(tags), r.randint(0, 3)) for _ in range(r.randint(0, 60)))
        wanted: dict = {}
        for what, part in walk(page):
            if what == OPEN:
                wanted.setdefault(part.path, [0, 0, set()])[0] += 1
            elif what not in (CLOSE, BREAK) and not part.sure and what.strip():
                size, name = 0 if part.noise else len(what.strip()), zlib.crc32(what.strip().encode())
                wanted.setdefault(f"{part.path}/", [1, 0, set()])
                for path in [f"{part.path}/", *_ancestors(part)]:
                    wanted[path][1] += size
                    wanted[path][2].add(name)
        assert structure(page) == {path: (n, size, sum(names) if names else None) for path, (n, size, names) in wanted.items()}


def _ancestors(part):
    while part:
        yield part.path
        part = part.above


def test_ids_of_single_pages_make_no_paths(spark):
    page = (
        '<html><body class="single postid-{0}"><div class="tagline">Best shop</div><div class="page page-{0}"><div id="post-{0}" class="entry tag-{0}">'
        '<h1>Story {0}</h1><p>Text {0}</p><div class="rating">Rate it</div></div></div><div class="imprint">Shop Ltd</div></body></html>'
    )
    rows = [(i, "http://a.example/", page.format(i), i, "x") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _host int, _template string")
    found = extract_main_text(pages)
    assert found.columns == ["page_id", "url", "html", "_host", "_template", "text", "n_chars"]
    assert {r.page_id: (r.text, r._host, r._template) for r in found.collect()} == {i: (f"Story {i}\nText {i}", i, "x") for i in range(12)}
    classes = templates(pages).first().classes
    assert {"html/body.single *", "html/body.single */div.page */div.*.entry *"} <= {t.token for c in classes for t in c.tokens}


def test_without_a_template_the_whole_body_counts(spark):
    page = '<body><div class="x{0}">Every page {0}</div><div class="site">Site</div></body>'
    few = [(i, "http://a.example/", page.format(i)) for i in range(3)]
    many = [(100 + i, "http://b.example/", page.format(i)) for i in range(4)]
    pages = spark.createDataFrame(few + many, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    assert found == {i: f"Every page {i}\nSite" for i in range(3)} | {100 + i: f"Every page {i}" for i in range(4)}
    assert extract_main_text(pages, repeats=3).where("page_id = 1").first().text == "Every page 1"
