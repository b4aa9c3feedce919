"""Token ids of whole texts by a public tokenizer.

Both vocabularies split a text at white space before they merge anything, so a
text's ids are the ids of its chunks, one after another. Each chunk goes through
the tokenizers library once per worker process and is remembered, which is what
makes whole corpora affordable; the result is that of encoding the whole text. A text that holds one of
the vocabulary's added tokens, such as a control string, is encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from gapwise.llm.spans import BLANK, VALUES, WINDOW, blocks, buffers, span_hashes, windows

#: Unicode's White_Space, spelled out because Python's \s has four more characters.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Chunks that no pre-token crosses, by kind of vocabulary.
CHUNKS = {
    "byte": re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"),
    "word": re.compile(f"[^{SPACE}]+"),
}
#: First and later bytes of white space beyond ASCII.
_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80")
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class ChunkEncoder:
    """Encodes texts chunk by chunk with a bounded memory of chunks met before.

    `kind` is "byte" (a space belongs to the word after it) or "word" (white
    space vanishes). The memory is a hash table of at most `remember` chunks, found
    by 64-bit hashes; when it is full, the half used longest ago goes. With `escape`,
    control strings in a text are ordinary text; without, they get their own ids, as
    is the library's default.
    """

    #: Added tokens that a text is searched for, and whether a search could miss one.
    added: tuple[bytes, ...] = ()
    hidden = False

    def __init__(self, path: str, kind: str, remember: int = 1_500_000, escape: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = escape
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if not (escape and t.special)]
        self.added = tuple(t.content.encode() for t in added)
        self.hidden = any(t.normalized for t in added)  # it is matched after changes to the text
        self.byte = kind == "byte"
        self.pattern = CHUNKS[kind]
        # a character that is one token by itself where the separator puts it
        self.mark, self.separator = ("\n", "\n") if self.byte else ("\x00", " \x00 ")
        (self.mark_id,) = self.tokenizer.encode(f"a{self.separator}a", add_special_tokens=False).ids[1:-1]
        self.remember = remember
        self.clock = 0
        self.buffers: dict[str, np.ndarray] = {}
        self._hold(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int32))

    # the memory: entry e has the ids ids[first[e]:first[e + 1]]
    def _hold(self, keys: np.ndarray, counts: np.ndarray, ids: np.ndarray, used: np.ndarray) -> None:
        self.slots = np.full(1 << max(20, int(4 * len(keys)).bit_length()), -1, np.int32)
        self.keys, self.ids, self.used = keys, ids, used
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self._place(0)

    def _append(self, name: str, values: np.ndarray) -> None:
        """Adds to the end of one of the arrays, in a buffer with a quarter to spare when it has to grow."""
        old, buffer = getattr(self, name), self.buffers.get(name)
        size = len(old) + len(values)
        if buffer is None or old.base is not buffer or size > len(buffer):
            buffer = np.empty(max(5 * size // 4, 1 << 12), old.dtype)
            buffer[: len(old)] = old
            self.buffers[name] = buffer
        buffer[len(old) : size] = values
        setattr(self, name, buffer[:size])

    def _place(self, start: int) -> None:
        """Puts the entries from `start` on into the table."""
        todo = np.arange(start, len(self.keys), dtype=np.int32)
        at = self._slot(self.keys[start:])
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            left = self.slots[at] != todo
            todo, at = todo[left], (at[left] + 1) & (len(self.slots) - 1)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 for unknown ones."""
        entry = self.slots[self._slot(hashes)]
        if not len(self.keys):
            return entry
        wrong = np.flatnonzero((entry >= 0) & (self.keys[entry] != hashes))
        at = self._slot(hashes[wrong])
        while len(wrong):
            at = (at + 1) & (len(self.slots) - 1)
            entry[wrong] = found = self.slots[at]
            left = (found >= 0) & (self.keys[found] != hashes[wrong])
            wrong, at = wrong[left], at[left]
        return entry

    def _forget(self) -> None:
        """Drops what was used longest ago, half of all or more."""
        if len(self.keys):
            self._keep(self.used > np.median(self.used))

    def _keep(self, keep: np.ndarray) -> None:
        counts = np.diff(self.first)
        self._hold(self.keys[keep], counts[keep], self.ids[np.repeat(keep, counts)], self.used[keep])

    def _entries(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each chunk of `data`; unknown ones are learned first."""
        hashes = span_hashes(data, start, end, VALUES)
        self.clock += 1
        entry = self._find(hashes)
        unknown = np.flatnonzero(entry < 0)
        if len(unknown):
            new, one = np.unique(hashes[unknown], return_index=True)
            if len(self.keys) + len(new) > self.remember:
                self._forget()
                unknown = np.flatnonzero(self._find(hashes) < 0)  # some of these chunks may be among what it forgot
                new, one = np.unique(hashes[unknown], return_index=True)
            raw, own = data.tobytes(), unknown[one]
            self._learn(new, [raw[i:j].decode() for i, j in zip(start[own].tolist(), end[own].tolist())])
            entry = self._find(hashes)
        self.used[entry] = self.clock
        return entry

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> None:
        found = [x for start in range(0, len(chunks), 200) for x in self._encoded(chunks[start : start + 200])]
        start, ends = len(self.keys), self.first[-1] + np.cumsum([len(x) for x in found])
        self._append("keys", hashes)
        self._append("first", ends)
        self._append("ids", np.concatenate(found))
        self._append("used", np.full(len(hashes), self.clock, np.int32))
        if 2 * len(self.keys) > len(self.slots):
            self._hold(self.keys, np.diff(self.first), self.ids, self.used)
        else:
            self._place(start)

    def _encoded(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of each chunk by one call of the library, with a separator's id between chunks."""
        joined = self.separator.join(chunks)
        if joined.count(self.mark) == len(chunks) - 1 and not any(map(str.isspace, chunks)):
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark_id)
            if len(cuts) == len(chunks) - 1:
                starts = np.concatenate([[0], cuts + 1]).tolist()
                return [ids[i:j] for i, j in zip(starts, [*cuts.tolist(), len(ids)])]
        return [self._whole(chunk) for chunk in chunks]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """For each text (null: empty) its ids, unsigned 32-bit."""
        data, offsets = buffers(texts)
        for row, last in blocks(offsets):
            own, cuts = data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
            if len(own) <= WINDOW:
                yield from self._block(own, cuts)
            elif self._odd(own, cuts)[0]:
                yield self._whole(own.tobytes().decode())
            else:
                yield np.concatenate([next(self._block(w, np.array([0, len(w)]))) for w in windows(own)])

    def _odd(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Whether a text has an added token, or white space that needs more than a look at single bytes."""
        if self.hidden:
            return np.ones(len(cuts) - 1, bool)
        at = [m.start() for m in _WIDE.finditer(data)] if len(data) else []
        if self.byte:  # runs of white space go to the words around them by rules of their own
            blank = BLANK[data]
            inner = blank[1:] & blank[:-1]
            at = np.concatenate([np.array(at, np.int64), np.flatnonzero(inner)])
        if self.added and len(data):
            raw = data.tobytes()
            at = np.concatenate([np.array(at, np.int64), np.array([i for token in self.added for i in _places(raw, token)], np.int64)])
        odd = np.zeros(len(cuts) - 1, bool)
        odd[np.searchsorted(cuts, np.array(at, np.int64), "right") - 1] = True
        return odd

    def _chunks(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each chunk: words, and a lone full stop or comma right behind letters by itself."""
        blank = BLANK[data]
        bounds = np.zeros(len(data) + 1, bool)
        bounds[cuts] = True
        if self.byte:
            bounds[:-1] |= blank
            bounds[1:] |= blank & (data != 32)
        else:
            bounds[:-1] |= blank
            bounds[1:] |= blank
        point = np.flatnonzero((data == 46) | (data == 44))
        ends = np.concatenate([blank, [True]]) | bounds
        latin = np.zeros(len(data), bool)  # the second byte of À to ÿ without the two signs among them
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        point = point[(point > 0) & ends[point + 1] & ~bounds[point]]
        point = point[_LETTER[data[point - 1]] | latin[point - 1]]
        bounds[point] = True
        edges = np.flatnonzero(bounds)
        start, end = edges[:-1], edges[1:]
        if not self.byte:
            inked = ~blank[start]
            start, end = start[inked], end[inked]
        return start, end

    def _block(self, data: np.ndarray, cuts: np.ndarray) -> Iterator[np.ndarray]:
        odd = self._odd(data, cuts)
        start, end = self._chunks(data, cuts) if len(data) else (cuts[:0], cuts[:0])
        of_odd = odd[np.searchsorted(cuts, start, "right") - 1] if odd.any() else np.zeros(len(start), bool)
        start, end = start[~of_odd], end[~of_odd]
        entry = self._entries(data, start, end)
        first, counts = self.first[entry], self.first[entry + 1] - self.first[entry]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(first - ends[:-1], counts) + np.arange(ends[-1])]
        bounds = ends[np.searchsorted(start, cuts)]
        for i in range(len(cuts) - 1):
            if odd[i]:
                yield self._whole(data[cuts[i] : cuts[i + 1]].tobytes().decode())
            else:
                yield ids[bounds[i] : bounds[i + 1]]


def _places(raw: bytes, token: bytes) -> Iterator[int]:
    at = raw.find(token)
    while at >= 0:
        yield at
        at = raw.find(token, at + 1)


@lru_cache(maxsize=4)
def encoder(path: str, kind: str, escape: bool = False) -> ChunkEncoder:
    """One encoder per worker process, so that later tasks find what earlier ones learned."""
    return ChunkEncoder(path, kind, escape=escape)


def check_tokenizer(path: str, kind: str) -> None:
    """Fails early, on the driver, if the vocabulary isn't of a kind whose chunks are known."""
    if kind not in CHUNKS:
        raise ValueError(f"kind is one of {sorted(CHUNKS)}, not {kind!r}")
    if not os.path.exists(path):
        raise FileNotFoundError(path)
