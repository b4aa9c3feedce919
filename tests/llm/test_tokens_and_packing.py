import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from gapwise.llm.packing import cut_pieces, pack  # noqa: E402
from gapwise.llm.packing_plan import configurations, plan  # noqa: E402
from gapwise.llm.staging import new_folder  # noqa: E402
from gapwise.llm.token_files import read_token_files, token_report, write_token_files  # noqa: E402
from gapwise.llm.tokens import ChunkEncoder  # noqa: E402

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
ODD = [
    "a  b", "  ", "\n\n x", "a \n b", "é́ x ́y", "", "\x1c a\x1fb", "it's  DON'T 's", "ΑΣ ΣΑΣ.", "a  b᠎ c", "x <|endoftext|> y",
    "ﬁ İ ẞ", " \n", " a\r\n\r\nb\tc", "a.b c., d.. é. ß, ×. 3. 4.5, ...", "w. \x00 x", " a.", "x\n", None, "\u0085x", "\U0001f600 y."
]


def whole(kind, texts):
    t = Tokenizer.from_file(public_tokenizers.path(FILES[kind]))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_chunks_give_the_ids_of_whole_texts(kind):
    r = random.Random(4)
    parts = ["a", "the", " ", ".", ",", "\n", "  ", "é", "Σ", " ", "9", "%", "'s", "\t", "日", "w.", "x,"]
    texts = ODD + ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(1500)]
    texts.append(" ".join(str(r.random()) + "é." for _ in range(80_000)))  # more than a window
    for remember in (1_500_000, 60):  # 60: it forgets all the time
        encoder = ChunkEncoder(public_tokenizers.path(FILES[kind]), kind, remember)
        some = texts if remember > 60 else texts[:500]
        wanted = whole(kind, some)
        assert [x.tolist() for x in encoder.encode(pa.array(some))] == wanted
        if remember == 60:
            for start in range(0, 500, 7):
                assert [x.tolist() for x in encoder.encode(pa.array(some[start : start + 7]))] == wanted[start : start + 7]


CONTROL = ["x <|endoftext|> y", "x<|endoftext|>y. z", "<|startoftext|><|endoftext|>", "a  <|endoftext|> \n b", "<|endoftext", "|> <|ENDOFTEXT|>", "plain <|endoftext |>", None]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_control_strings_get_their_own_ids(spark, kind):
    plain = Tokenizer.from_file(public_tokenizers.path(FILES[kind]))
    texts = [*CONTROL, " ".join(["word."] * 300_000) + " <|endoftext|> z"]  # the last: more than a window
    wanted = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert wanted != whole(kind, texts)
    encoder = ChunkEncoder(public_tokenizers.path(FILES[kind]), kind, escape=False)
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == wanted
    docs = spark.createDataFrame(list(enumerate(CONTROL)), "doc_id long, text string")
    sums = [zlib.crc32(np.array([*ids, 0], "<u4")) for ids in wanted[:-1]]
    pieces = cut_pieces(docs, public_tokenizers.path(FILES[kind]), kind).orderBy("doc_id").collect()
    assert [p.ids_crc32 for p in pieces] == sums
    path = new_folder(spark, "test")
    write_token_files(docs, path, public_tokenizers.path(FILES[kind]), kind)
    assert [r.ids_crc32 for r in token_report(spark, path).orderBy("doc_id").collect()] == sums


def test_token_files_come_back_in_order(spark):
    rows = [(i * 7 % 101, f"text {i} é" * (i % 9)) for i in range(101)] + [(500, None), (500, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS start", "0 AS part")
    path = new_folder(spark, "test")
    write_token_files(docs.repartition(5), path, public_tokenizers.path(FILES["byte"]), parts=4)
    found = token_report(spark, path).orderBy("start").collect()
    ids = [x + [0] for x in whole("byte", [t for _, t in rows])]
    by_id = {i: x for (i, _), x in zip(rows, ids)}
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    for r in found:
        want = np.array(by_id[r.doc_id], "<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(want), zlib.crc32(want))
    plan_ = read_token_files(spark, path).where("doc_id = 5")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in plan_


def test_no_documents(spark):
    path = new_folder(spark, "test")
    none = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(none, path, public_tokenizers.path(FILES["byte"]))
    assert token_report(spark, path).count() == 0
    assert pack(cut_pieces(none, public_tokenizers.path(FILES["word"]))).count() == 0


def test_pieces_fill_sequences_without_holes(spark):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["ab", "cde", "f"]) for _ in range(r.choice([0, 1, 30, 400])))) for i in range(300)] + [(-1, None), (-2, "z " * 150), (-2, "z " * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS length")
    found = pack(cut_pieces(docs, public_tokenizers.path(FILES["word"]), capacity=64).withColumnRenamed("start", "begin"), capacity=64).collect()
    ids = {i: x + [0] for (i, _), x in zip(rows, whole("word", [t for _, t in rows]))}
    for p in found:
        own = np.array(ids[p.doc_id][p.begin : p.begin + p.length], "<u4")
        assert p.begin == 64 * p.piece and len(own) == p.length and p.ids_crc32 == zlib.crc32(own)
    assert sum(p.length for p in found) == sum(len(x) for x in ids.values()) + len(ids[-2])
    places = {}
    for p in found:
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) <= 1.02 * -(-sum(p.length for p in found) // 64) + 1


def test_lengths_that_cannot_be_packed(spark):
    for bad in (0, 65, None):
        with pytest.raises(ValueError):
            pack(spark.createDataFrame([(1, bad)], "doc_id long, length long"), capacity=64)


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_all_pieces_and_few_bins(seed):
    r = random.Random(seed)
    histogram = Counter(min(2048, max(1, int(r.lognormvariate(6.4, 0.9)))) for _ in range((20, 300, 3000, 20000)[seed]))
    bins = plan(histogram, 2048)
    got = Counter()
    for b in bins:
        assert b.count > 0 and b.gap == 2048 - sum(x * k for x, k in b.runs) >= 0
        for x, k in b.runs:
            got[x] += k * b.count
    assert got == histogram
    least = max(-(-sum(x * n for x, n in histogram.items()) // 2048), sum(n for x, n in histogram.items() if x > 1024))
    assert sum(b.count for b in bins) <= 1.01 * least + 1


def test_configurations_are_optimal():
    found = configurations([6, 4], [100, 100], 10)
    assert abs(sum(n for _, n in found) - 100) < 1e-6
    assert plan({}, 10) == []
