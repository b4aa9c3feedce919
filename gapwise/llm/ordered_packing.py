"""Packs documents into sequences in their order, cut where it hurts least."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.tokens import check_tokenizer, encoder
from gapwise.llm.window_cuts import Costs, allowed, best_windows, path, settled

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Characters that end a sentence, and what vocabularies write around them: an end of word, a line end.
SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？", "Ċ")
#: Tokens that are planned at once. What lies before the last place that all plans pass leaves the buffer.
BLOCK = 1 << 20


def pack_in_order(
    docs: DataFrame, tokenizer: str, kind: str = "word", end_id: int = 2, capacity: int = 4096, costs: Costs = Costs(), keep_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its `text` and `end_id`; `start` counts its ids before
    the piece, `doc_tokens` all of them. Sequences hold at most `capacity` ids (a
    power of two), from offset 0 without a hole; with `keep_ids` the column `ids` has
    each piece's ids. A null text is empty and gives one id. Rows without doc_id and
    repeated rows are documents each for itself. Other columns are not read. Without
    rows the result is empty. A control string in a text gets its own id.

    Documents follow each other as the rows do in their partition, so that nothing
    is shuffled, whatever has most rows; sort `docs` before for another order.
    Cuts are allowed behind documents, sentences (tokens that end with a full stop or
    the like) and, in stretches without these, every `costs.stretch` tokens. The
    plan has the least sum of padding and `costs` of all plans for a partition's
    tokens, over these places; behind the last `capacity` tokens of a partition any
    token may be followed by a cut, so that its end needs no padding. Only plans that
    don't meet again within four blocks of 2^20 tokens are settled by the block.
    """
    check_tokenizer(tokenizer, kind)
    if capacity < 1 or capacity & (capacity - 1) or not 0 < costs.stretch <= capacity:
        raise ValueError("capacity is a power of two and not below the stretch")
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of, end = encoder(tokenizer, kind).encode, np.array([end_id], "<u4")
        open_ = Buffer(capacity, costs, sentence_table(tokenizer), TaskContext.get().partitionId() << 33, keep_ids)
        for got in batches:
            for doc_id, ids in zip(got.column(0).to_pylist(), ids_of(got.column(1))):
                open_.add(doc_id, np.concatenate([ids, end]).astype("<u4", copy=False))
                if open_.size >= open_.enough:
                    yield from open_.settle()
        yield from open_.finish()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(fill, schema)


@lru_cache(maxsize=4)
def sentence_table(tokenizer: str) -> np.ndarray:
    """For each id whether its token ends a sentence."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(tokenizer).get_vocab()
    table = np.zeros(max(vocabulary.values()) + 1, bool)
    table[[i for token, i in vocabulary.items() if token.removesuffix("</w>").endswith(SENTENCE_ENDS)]] = True
    return table


class Buffer:
    """The ids of one task that are not in a finished sequence yet."""

    def __init__(self, capacity: int, costs: Costs, ends_sentence: np.ndarray, first_sequence: int, keep_ids: bool):
        self.capacity, self.costs, self.ends_sentence = capacity, costs, ends_sentence
        self.sequence, self.keep_ids = first_sequence, keep_ids
        self.docs: list[tuple[int | None, int, int]] = []  # doc_id, ids that left the buffer, all ids
        self.ids: list[np.ndarray] = []
        self.size, self.enough = 0, BLOCK

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, 0, len(ids)))
        self.ids.append(ids)
        self.size += len(ids)

    def _plan(self, free_from: int | None) -> tuple[np.ndarray, np.ndarray, list[int]]:
        flat = np.concatenate(self.ids)
        known = flat < len(self.ends_sentence)
        sentences = np.flatnonzero(known & self.ends_sentence[np.where(known, flat, 0)]) + 1
        at, cost = allowed(np.cumsum([len(x) for x in self.ids]), sentences, self.costs, free_from)
        return flat, at, best_windows(at, cost, self.capacity, self.costs.opening)

    def settle(self) -> Iterator[pa.RecordBatch]:
        """Hands out the sequences that no later document can change."""
        flat, at, back = self._plan(None)
        upto = settled(at, back, self.capacity)
        if not upto and self.size >= 4 * BLOCK:
            plan = path(back, len(at) - 1)
            upto = plan[len(plan) // 2]
        if upto:
            yield self._cut(flat, at[path(back, upto)])
        self.enough = self.size + BLOCK

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            flat, at, back = self._plan(self.size - self.capacity)
            yield self._cut(flat, at[path(back, len(at) - 1)])

    def _cut(self, flat: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        """The pieces up to the last cut; they leave the buffer."""
        bounds = np.cumsum([0] + [len(x) for x in self.ids])
        edges = np.unique(np.concatenate([cuts, bounds[bounds < cuts[-1]]]))
        start, end = edges[:-1], edges[1:]
        own = np.searchsorted(bounds, start, "right") - 1
        window = np.searchsorted(cuts, start, "right") - 1
        gone = np.array([d[1] for d in self.docs], np.int64)
        total = np.array([d[2] for d in self.docs], np.int64)
        sums = [zlib.crc32(flat[i:j]) for i, j in zip(start.tolist(), end.tolist())]
        columns = {
            "doc_id": pa.array([self.docs[i][0] for i in own.tolist()], pa.int64()),
            "start": pa.array(start - bounds[own] + gone[own]),
            "length": pa.array(end - start),
            "ids_crc32": pa.array(sums, pa.int64()),
            "doc_tokens": pa.array(total[own]),
            "sequence_id": pa.array(self.sequence + window),
            "offset": pa.array(start - cuts[window]),
        }
        if self.keep_ids:
            offsets = pa.array(np.append(start, cuts[-1]).astype(np.int32))
            columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(flat[: cuts[-1]].astype(np.int32)))
        self.sequence += len(cuts) - 1
        last = int(np.searchsorted(bounds, cuts[-1], "right")) - 1  # the document that goes on behind the last cut
        if last < len(self.docs):
            doc_id, before, all_ = self.docs[last]
            taken = int(cuts[-1] - bounds[last])
            self.docs = [(doc_id, before + taken, all_), *self.docs[last + 1 :]]
            self.ids = [self.ids[last][taken:], *self.ids[last + 1 :]]
        else:
            self.docs, self.ids = [], []
        self.size -= int(cuts[-1])
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
