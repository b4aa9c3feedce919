"""N-best segmentations of texts into the pieces of a SentencePiece vocabulary, and back.

The lattice of a text has an edge for each piece of the vocabulary that stands in
it; a character that no piece has is one edge to the pieces of its bytes. A
segmentation's score is the sum of its pieces' scores in the vocabulary. No piece
reaches over certain places (before a space, around a line feed), so the lattice
falls apart there and the parts are solved each for itself, once per worker
process while they are remembered.
"""

from __future__ import annotations

import gc
import heapq
import os
import re
from bisect import insort
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.spans import WINDOW, blocks, buffers, windows
from gapwise.llm.tokens import ChunkEncoder

SPACE = "▁"
#: (score less than the best one's, ids)
Other = tuple[float, tuple[int, ...]]


class Node(dict):
    """What stands before an end of pieces, by character; `known` has score and ids if it is a piece itself."""

    __slots__ = ("known",)

    def __init__(self):
        self.known: tuple[float, tuple[int, ...]] | None = None


def _trie(pieces: Iterable[str], kind: type[dict]) -> Iterator[tuple[str, dict]]:
    """Each piece and its node in a new trie, whose root comes first, with an empty piece."""
    root = kind()
    yield "", root
    for piece in pieces:
        node = root
        for char in piece:
            following = node.get(char)
            if following is None:
                following = node[char] = kind()
            node = following
        yield piece, node


class Vocabulary:
    """Pieces, their scores and bytes. `SPACE` stands for a space; where a text has that character itself, its bytes do."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary needs a piece for each byte")
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = {model.id_to_piece(i): (model.get_score(i), i) for i in plain}
        if any(re.search(rf"[^{SPACE}]{SPACE}|\n|[A-Za-zÀ-ÖØ-öø-ÿ][.,]", piece) for piece in scores):
            raise ValueError("a piece goes on over a place where chunks are cut")
        # as for a character unknown to a unigram model: worse than any ordinary piece
        self.unknown = min((s for s, _ in scores.values() if s > -1e8), default=0.0) - 10
        self.scores = {piece: (score, (i,)) for piece, (score, i) in scores.items()}
        #: Pieces from their ends, one character before another.
        nodes = _trie((piece[::-1] for piece in scores), Node)
        self.ends = next(nodes)[1]
        for piece, node in nodes:
            node.known = self.scores[piece[::-1]]
        #: The lattice of the text solved last, of which a text with the same beginning keeps that part.
        self.padded, self.best, self.into = END, [0.0], [[]]
        #: Pairs of characters within pieces; between others the lattice falls apart.
        self.pairs = {piece[i : i + 2] for piece in scores for i in range(len(piece) - 1)}
        self.parts: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = {}
        self.raw = [b""] * len(ids)
        for piece, (_, i) in scores.items():
            self.raw[i] = piece.replace(SPACE, " ").encode()
        for byte, i in self.byte_ids.items():
            self.raw[i] = bytes([byte])

    @cached_property
    def trie(self) -> dict:
        """Pieces, one character after another; what stands at "" has score and ids of one that ends there."""
        nodes = _trie(self.scores, dict)
        root = next(nodes)[1]
        for piece, node in nodes:
            node[""] = self.scores[piece]
        return root

    def _lattice(self, text: str) -> tuple[list[float], list[list[tuple[float, int, float, tuple[int, ...]]]]]:
        """Best score of each beginning of a text, and the edges into its end, by ascending start.

        An edge is the best score with it, its start, its own score and its ids. Both
        depend on that beginning alone, so what the text solved before has in common is
        taken over: texts in order share most of it.
        """
        best, into, padded, ends, unknown = self.best, self.into, END + text, self.ends, self.unknown
        same, most = 1, min(len(padded), len(self.padded))
        while same < most and padded[same] == self.padded[same]:
            same += 1
        del best[same:], into[same:]
        self.padded = padded[:same]
        for end in range(same, len(padded)):
            start, edges, top = end - 1, [], -1e300
            node = ends.get(padded[end])
            if node is None or node.known is None:
                char = padded[end]
                ids = tuple(self.byte_ids[b] for b in (SPACE if char == LITERAL else char).encode())
                top = best[start] + unknown
                edges.append((top, start, unknown, ids))
            while node is not None:
                known = node.known
                if known is not None:
                    score, ids = known
                    total = best[start] + score
                    edges.append((total, start, score, ids))
                    if total > top:
                        top = total
                node = node.get(padded[start])
                start -= 1
            edges.reverse()
            best.append(top)
            into.append(edges)
        self.padded = padded
        return best, into

    def n_best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The `n` segmentations of highest score, best first; equal ones in the order the search meets them.

        Forward, Viterbi's algorithm finds the best score of each beginning of the
        text. Backward, A* extends partial segmentations from the end; what is left
        to the beginning is known exactly, so complete ones come out in order.
        """
        size, (best, into) = len(text), self._lattice(text)
        # each open one stands for at least one segmentation of exactly its score, so more than are wanted never count
        open_, found, count, wanted = [(-best[size], 0, size, 0.0, ())], [], 0, n
        while open_ and wanted:
            total, _, at, behind, ids = open_.pop(0)
            if not at:
                found.append((-total, ids))
                wanted -= 1
                continue
            held = len(open_)
            for whole, start, score, own in into[at]:
                total = -(whole + behind)
                if held < wanted:
                    held += 1
                elif total < open_[-1][0]:
                    open_.pop()
                else:
                    continue
                count += 1
                insort(open_, (total, count, start, score + behind, own + ids))
        return found

    def solved(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """`n_best`, put together from parts between which no piece reaches."""
        if self.pairs.issuperset(map(add, text, text[1:])):
            return self.n_best(text, n)
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in self.pairs]
        total = [(0.0, ())]
        for start, end in zip([0, *cuts], [*cuts, len(text)]):
            own = self._part(text[start:end], n)
            if len(own) == 1:
                total = [(s + own[0][0], a + own[0][1]) for s, a in total]
            else:
                total = sorted(((s + t, a + b) for s, a in total for t, b in own), key=lambda x: -x[0])[:n]
        return total

    def _part(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """`n_best` of a part of a word, which many words may share; a bounded number is remembered."""
        key = (text, n)
        if key not in self.parts:
            if len(self.parts) >= PARTS:
                self.parts.clear()
            self.parts[key] = self.n_best(text, n)
        return self.parts[key]


#: Parts of words whose segmentations a worker remembers, with texts of up to a word's length.
PARTS = 50_000
#: Stands for a literal SPACE in lattices; half a surrogate pair, which no text holds.
LITERAL = "\ud800"
#: Stands before a text in its lattice, and goes on no piece; half a surrogate pair too.
END = "\ud801"


def lattice_text(text: str) -> str:
    return text.replace(SPACE, LITERAL).replace(" ", SPACE)


class PieceEncoder(ChunkEncoder):
    """Segments whole texts; remembers at most `remember` chunks, of which the half used longest ago goes."""

    def __init__(self, path: str, n: int, remember: int = 600_000):
        self.vocabulary, self.n = Vocabulary(path), n
        self.byte, self.remember, self.clock = True, remember, 0
        self.buffers: dict[str, np.ndarray] = {}
        self._hold(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int32))
        self.scores, self.gaps = np.zeros(0), np.zeros(0)
        self.n_others, self.lost = np.zeros(0, np.int8), np.zeros(0)  # of each entry; of all others, one entry after another
        self.other_sizes, self.other_ids = np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self._index()

    def _solve(self, chunk: str) -> tuple[float, tuple[int, ...], list[Other]]:
        (score, ids), *others = self.vocabulary.solved(lattice_text(chunk), self.n)
        return score, ids, [(score - s, own) for s, own in others]

    def _index(self) -> None:
        self.first_other = np.concatenate([[0], np.cumsum(self.n_others, dtype=np.int64)])
        self.first_id = np.concatenate([[0], np.cumsum(self.other_sizes, dtype=np.int64)])

    def _others(self, entry: int) -> list[Other]:
        """(score less than the best one's, ids) of the other segmentations of a chunk."""
        own = range(self.first_other[entry], self.first_other[entry + 1])
        return [(float(self.lost[i]), tuple(self.other_ids[self.first_id[i] : self.first_id[i + 1]].tolist())) for i in own]

    def _keep(self, keep: np.ndarray) -> None:
        others = np.repeat(keep, self.n_others)
        self.other_ids = self.other_ids[np.repeat(others, self.other_sizes)]
        self.other_sizes, self.lost = self.other_sizes[others], self.lost[others]
        self.scores, self.gaps, self.n_others = self.scores[keep], self.gaps[keep], self.n_others[keep]
        super()._keep(keep)
        self._index()

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> None:
        collecting = gc.isenabled()
        gc.disable()  # the search makes many tuples and no cycles
        try:
            solved = {chunk: self._solve(chunk) for chunk in sorted(chunks)}  # in order, as beginnings are shared
            found = [solved[chunk] for chunk in chunks]
        finally:
            if collecting:
                gc.enable()
        start, ends = len(self.keys), self.first[-1] + np.cumsum([len(ids) for _, ids, _ in found])
        others = [x for _, _, own in found for x in own]
        n_others, sizes = [len(own) for _, _, own in found], [len(ids) for _, ids in others]
        for name, values in (
            ("keys", hashes),
            ("first", ends),
            ("ids", np.array([i for _, ids, _ in found for i in ids], np.uint32)),
            ("used", np.full(len(hashes), self.clock, np.int32)),
            ("scores", np.array([s for s, _, _ in found])),
            ("gaps", np.array([own[0][0] if own else np.inf for _, _, own in found])),
            ("first_other", self.first_other[-1] + np.cumsum(n_others, dtype=np.int64)),
            ("first_id", self.first_id[-1] + np.cumsum(sizes, dtype=np.int64)),
            ("n_others", np.array(n_others, np.int8)),
            ("lost", np.array([less for less, _ in others])),
            ("other_sizes", np.array(sizes, np.int32)),
            ("other_ids", np.array([i for _, ids in others for i in ids], np.uint32)),
        ):
            self._append(name, values)
        if 2 * len(self.keys) > len(self.slots):
            self._hold(self.keys, np.diff(self.first), self.ids, self.used)
        else:
            self._place(start)

    def segment(self, texts: pa.Array) -> Iterator[tuple[float, np.ndarray, list[tuple[float, list]]]]:
        """For each text (null: empty) score, ids and the other segmentations of the best `n`: (score, [(at, drop, ids)])."""
        texts, empty, space = texts.cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        spaced = pc.if_else(pc.equal(texts, empty), empty, pc.binary_join_element_wise(space, texts, empty))
        data, offsets = buffers(spaced)
        for row, last in blocks(offsets):
            own, cuts = data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
            if len(own) <= WINDOW:
                yield from (self._joined([x]) for x in self._parts(own, cuts))
            elif self._odd(own, cuts)[0]:
                yield self._joined([self._slow(own.tobytes().decode())])
            else:
                yield self._joined([next(self._parts(w, np.array([0, len(w)]))) for w in windows(own)])

    def _odd(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        odd = super()._odd(data, cuts)  # and white space that pieces may hold
        at = np.flatnonzero((data == 9) | (data > 10) & (data < 14))
        odd[np.searchsorted(cuts, at, "right") - 1] = True
        return odd

    def _parts(self, data: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[float, np.ndarray, list]]:
        """Score, ids, and the alternatives nearest to the best, for each text: (gap, at, drop, others)."""
        odd = self._odd(data, cuts)
        start, end = self._chunks(data, cuts) if len(data) else (cuts[:0], cuts[:0])
        regular = ~odd[np.searchsorted(cuts, start, "right") - 1]
        start, end = start[regular], end[regular]
        entry = self._entries(data, start, end)
        first, counts = self.first[entry], self.first[entry + 1] - self.first[entry]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(first - ends[:-1], counts) + np.arange(ends[-1])]
        bounds = np.searchsorted(start, cuts)
        scores, gaps = self.scores[entry], self.gaps[entry]
        for i in range(len(cuts) - 1):
            if odd[i]:
                yield self._slow(data[cuts[i] : cuts[i + 1]].tobytes().decode())
                continue
            a, b = bounds[i], bounds[i + 1]
            near = np.argsort(gaps[a:b], kind="stable")[: self.n - 1] + a if b - a <= self.n else a + self._least(gaps[a:b])
            others = [(gaps[c], int(ends[c] - ends[a]), int(counts[c]), self._others(entry[c])) for c in near.tolist() if gaps[c] < np.inf]
            yield float(scores[a:b].sum()), ids[ends[a] : ends[b]], others

    def _least(self, gaps: np.ndarray) -> np.ndarray:
        """Places of the n - 1 least gaps, earlier ones first among equals."""
        if self.n < 2:
            return np.zeros(0, np.int64)
        limit = np.partition(gaps, self.n - 2)[self.n - 2]
        close = np.flatnonzero(gaps <= limit)
        return close[np.argsort(gaps[close], kind="stable")[: self.n - 1]]

    def _slow(self, text: str) -> tuple[float, np.ndarray, list]:
        """The same for a text with white space that needs a closer look, chunk by chunk."""
        score, ids, others = 0.0, [], []
        for chunk in re.findall(r" *[^ \n]+| +|\n", text):
            own, best, rest = self._solve(chunk)
            if rest:
                others.append((rest[0][0], len(ids), len(best), rest))
            score += own
            ids += best
        return score, np.array(ids, np.uint32), heapq.nsmallest(self.n - 1, others, key=lambda x: (x[0], x[1]))

    def _joined(self, parts: list[tuple[float, np.ndarray, list]]) -> tuple[float, np.ndarray, list[tuple[float, list]]]:
        """The best `n` of a whole text. Besides the best one they change only the n - 1 chunks with the least gaps."""
        score, at, near = sum(p[0] for p in parts), 0, []
        for _, ids, others in parts:
            near += [(gap, at + place, drop, own) for gap, place, drop, own in others]
            at += len(ids)
        found: list[tuple[float, list]] = [(0.0, [])]
        for _, place, drop, own in heapq.nsmallest(self.n - 1, near, key=lambda x: (x[0], x[1])):
            changed = [(lost + less, [*edits, (place, drop, list(ids))]) for lost, edits in found for less, ids in own]
            found = sorted(found + changed, key=lambda x: x[0])[: self.n]
        ids = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint32)
        return score, ids, [(score - lost, sorted(edits)) for lost, edits in found[1:]]


@lru_cache(maxsize=2)
def piece_encoder(path: str, n: int) -> PieceEncoder:
    """One encoder per worker process."""
    return PieceEncoder(path, n)


@lru_cache(maxsize=2)
def _raw_pieces(path: str) -> tuple[np.ndarray, np.ndarray]:
    raw = Vocabulary(path).raw
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


EDIT = "struct<at: int, drop: int, ids: array<int>>"
N_BEST = f"doc_id long, score double, ids array<int>, others array<struct<score: double, edits: array<{EDIT}>>>"


def encode_n_best(docs: DataFrame, model: str, n: int = 3) -> DataFrame:
    """doc_id, score, ids and `others`, the rest of the `n` best segmentations of each whole `text`.

    An other one is its score and edits of the best: `drop` ids from place `at` on
    become `ids`. A null or empty text has no ids, score 0 and no others; a short one
    may have fewer than `n`. Repeated rows stay; other columns are not read.
    """
    if n < 1:
        raise ValueError("n is at least 1")
    if not os.path.exists(model):
        raise FileNotFoundError(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edit = pa.list_(pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))]))
        other = pa.list_(pa.struct([("score", pa.float64()), ("edits", edit)]))
        for got in batches:
            start, rows, size = 0, [], 0

            def batch(stop: int) -> pa.RecordBatch:
                ends = pa.array(np.cumsum([0, *(len(ids) for _, ids, _ in rows)]).astype(np.int32))
                ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([ids for _, ids, _ in rows]).astype(np.int32)))
                rest = [
                    [{"score": s, "edits": [{"at": a, "drop": d, "ids": i} for a, d, i in edits]} for s, edits in others] for _, _, others in rows
                ]
                columns = [got.column(0).slice(start, stop - start), pa.array([s for s, _, _ in rows], pa.float64()), ids, pa.array(rest, other)]
                return pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "ids", "others"])

            for i, row in enumerate(piece_encoder(model, n).segment(got.column(1))):
                rows.append(row)
                size += len(row[1])
                if size > 200_000:
                    yield batch(i + 1)
                    start, rows, size = i + 1, [], 0
            if rows:
                yield batch(len(got))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(encode, N_BEST)


def decoded(ids: str | Column, model: str) -> Column:
    """The text of an array of ids."""

    @F.arrow_udf("string")
    def texts(found: pa.Array) -> pa.Array:
        piece_encoder.cache_clear()  # a worker that has encoded before decodes now
        raw, first = _raw_pieces(model)
        sizes = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        flat, out, row = found.flatten(), [], 0
        while row < len(sizes):  # some hundred thousand ids at once
            last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + 200_000, "right")) - 1)
            own = flat.slice(bounds[row], bounds[last] - bounds[row]).to_numpy(zero_copy_only=False).astype(np.int64)
            size = first[own + 1] - first[own]
            ends = np.concatenate([[0], np.cumsum(size)])
            data = raw[np.repeat(first[own] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
            at = ends[bounds[row : last + 1] - bounds[row]].tolist()
            out += [data[i + 1 : j].decode() for i, j in zip(at[:-1], at[1:])]  # without the space in front
            row = last
        return pa.array(out, pa.string())

    return texts(ids)


def edited(ids: str | Column, edits: Column) -> Column:
    """The ids of another segmentation from the best one's and its edits (in ascending order)."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    start = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, e: Column) -> Column:
        kept = F.slice(ids, state["at"] + 1, e["at"] - state["at"])
        return F.struct(F.concat(state["done"], kept, e["ids"]).alias("done"), (e["at"] + e["drop"]).alias("at"))

    return F.aggregate(edits, start, step, lambda s: F.concat(s["done"], F.slice(ids, s["at"] + 1, F.size(ids))))
