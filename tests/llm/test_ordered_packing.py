import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from gapwise.llm import ordered_packing  # noqa: E402
from gapwise.llm.ordered_packing import Buffer, pack_in_order  # noqa: E402
from gapwise.llm.window_cuts import Costs, allowed, best_windows, padding, path, settled  # noqa: E402

WORDS = public_tokenizers.path("word_bpe_49k.json")


def cheapest(at, cost, capacity, opening):
    """The least cost of cutting at the last place, by trying every window."""
    value = [0]
    for j in range(1, len(at)):
        ways = [value[i] + padding(at[j] - at[i], capacity) for i in range(j) if at[j] - at[i] <= capacity]
        value.append(min(ways) + cost[j] + opening)
    return value[-1]


def cost_of(cuts, at, cost, capacity, opening):
    fee = dict(zip(at, cost))
    return sum(fee[j] + opening + padding(j - i, capacity) for i, j in zip(cuts, cuts[1:]))


@pytest.mark.parametrize("seed", range(40))
def test_the_plan_is_as_cheap_as_any(seed):
    r = random.Random(seed)
    capacity = 1 << r.randint(2, 7)
    costs = Costs(r.randint(0, 6), r.randint(0, 20), r.randint(0, 4), r.randint(1, capacity))
    lengths = [r.choice([1, 1, r.randint(1, 9), r.randint(1, 3 * capacity)]) for _ in range(r.randint(1, 25))]
    ends = np.cumsum(lengths)
    sentences = np.array(sorted(r.sample(range(1, ends[-1] + 1), r.randint(0, int(ends[-1]) // 3))), int)
    at, cost = allowed(ends, sentences, costs, r.choice([None, int(ends[-1]) - capacity]))
    assert np.diff(at).max() <= costs.stretch and (np.diff(at) > 0).all()
    cuts = at[path(best_windows(at, cost, capacity, costs.opening), len(at) - 1)].tolist()
    assert cuts[0] == 0 and cuts[-1] == ends[-1]
    assert cost_of(cuts, at.tolist(), cost.tolist(), capacity, costs.opening) == cheapest(at.tolist(), cost.tolist(), capacity, costs.opening)


@pytest.mark.parametrize("seed", range(10))
def test_what_is_settled_is_part_of_every_later_plan(seed):
    r = random.Random(seed)
    ends = np.cumsum([r.randint(1, 60) for _ in range(300)])
    sentences = np.array(sorted(r.sample(range(1, int(ends[-1]) + 1), int(ends[-1]) // 9)))
    at, cost = allowed(ends, sentences, Costs(3, 9, 1, 16))
    back = best_windows(at, cost, 64, 1)
    upto = settled(at, back, 64)
    assert upto > len(at) // 2
    for last in range(int(np.searchsorted(at, at[-1] - 64, "right")), len(at)):
        assert upto in path(back, last)


def test_blocks_give_the_plan_of_the_whole(monkeypatch):
    """Sequences that leave the buffer early are those of one plan for all tokens."""
    r = np.random.default_rng(3)
    docs = [r.integers(0, 50, r.integers(1, 300)).astype("<u4") for _ in range(2000)]
    table = np.zeros(50, bool)
    table[:3] = True
    found = []
    for block in (4_000, 1 << 30):
        monkeypatch.setattr(ordered_packing, "BLOCK", block)
        buffer, out = Buffer(256, Costs(4, 16, 2, 32), table, 0, True), []
        for i, ids in enumerate(docs):
            buffer.add(i, ids)
            if buffer.size >= buffer.enough:
                out += buffer.settle()
        out += buffer.finish()
        assert len(out) > 3 or block > 4_000
        found.append([tuple(x.values()) for batch in out for x in batch.to_pylist()])
    assert found[0] == found[1]


ODD = ["", None, "a.", "One. Two! Three? four", "x <|endoftext|> y", "word " * 9000, "A sentence here. " * 3000, "\n \t", "日本。語"] * 2


def test_pieces_are_those_of_the_tokenizer(spark):
    texts = ODD + [" ".join(["Some words of a text, and more."] * n) for n in range(0, 900, 7)]
    rows = [(None if i == 5 else i // 2, t, 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, sequence_id int")
    found = pack_in_order(docs.repartition(3, "doc_id"), WORDS, keep_ids=True).collect()
    plain = Tokenizer.from_file(WORDS)
    wanted = sorted((str(i), [*plain.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, *_ in rows)
    by_sequence, got, open_ = {}, [], []
    for r in found:  # rows of a partition come in order, so that a document's pieces follow each other
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4"))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["start"] == len(open_)
        open_ += r["ids"]
        if len(open_) == r["doc_tokens"]:
            got.append((str(r["doc_id"]), open_))
            open_ = []
    assert not open_ and sorted(got) == wanted
    padded = 0
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        length = sum(n for _, n in places)
        assert length <= 4096
        padded += padding(length, 4096)
    assert padded < 0.02 * sum(len(ids) for _, ids in wanted)


def test_order_is_kept_and_nothing_is_shuffled(spark):
    docs = spark.range(400, numPartitions=1).selectExpr("id AS doc_id", "repeat('Words of it. ', cast(id as int) % 90) AS text")
    packed = pack_in_order(docs, WORDS)
    places = [(r["sequence_id"], r["offset"]) for r in packed.collect()]
    ids = [r["doc_id"] for r in packed.collect()]
    assert places == sorted(places) and ids == sorted(ids)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_in_order(empty, WORDS).collect() == []
    with pytest.raises(ValueError):
        pack_in_order(empty, WORDS, capacity=3000)
