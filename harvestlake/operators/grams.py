"""n-grams of texts as numbers, worked out over the bytes of many texts at once.

An n-gram is bytes of a text, and its number a polynomial hash of them, taken from running sums
over all texts of a slice, so that its length costs nothing. Equal numbers of different n-grams
only cost a verification. A text that contains a term also has the term's n-grams of every kind:
white space that an n-gram stands behind, or that a word stands between, is inside the term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Kinds of n-grams that queries are filed under, the last that one of the terms has: at any place of
#: the text, or only behind white space, of which a text has far fewer. As many bytes each.
ANYWHERE, BEHIND_SPACE = (1, 2, 3, 8), (6, 9, 12)
#: The last kinds: a whole word with the white space around it and so many bytes before and behind. A text
#: has no more of each than of those behind white space, and far fewer texts share one.
AROUND_WORD = ((3, 3), (3, 5), (5, 3), (5, 5))
FIRST_AROUND = len(ANYWHERE) + len(BEHIND_SPACE)
N_KINDS = FIRST_AROUND + len(AROUND_WORD)
#: Bytes on either side of an n-gram of the last kinds, to the end of its word, that go with it.
REACH = 32
#: Bytes of whole texts that are worked on at once, few enough for the processor's cache.
SLICE_BYTES = 1 << 18
#: Places in the bitmap that an n-gram has, and by how many bits of its number they are apart.
PLACES, PLACE_SHIFT = 3, 19

_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xFF51AFD7ED558CCD)
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\f\r"))


#: Picks the n-grams, by their numbers, that are to be kept.
Passes = Callable[[np.ndarray], np.ndarray]


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``1 << bits`` of each."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(1 << bits, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class Slice:
    """Whole texts one behind the other: ``data``, and where each begins and the last ends."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        power, self._inverse = _powers(max(20, len(data).bit_length()))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(power[: len(data)] * data, out=self._sums[1:])
        self._spaces = np.flatnonzero(_SPACE[data])

    def hash(self, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
        h = self._sums[end]
        h -= self._sums[start]
        h *= self._inverse[start]
        h += np.uint64(seed)
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        return h

    def words(self, passes: Passes | None) -> tuple[np.ndarray, np.ndarray]:
        """Words with white space on either side, by the place of the first of it, with their cores.

        The core is the number of the smallest n-gram around the word, which each larger one contains.
        """
        word = np.flatnonzero(np.diff(self._spaces) > 1)
        left, right = AROUND_WORD[0]
        start, end = self._spaces[word] - left, self._spaces[word + 1] + 1 + right
        inside = slice(*np.searchsorted(start, [0]), np.searchsorted(end, len(self.data), "right"))
        word, core = word[inside], self.hash(start[inside], end[inside], N_KINDS)
        kept = passes(core) if passes else slice(None)
        return word[kept], core[kept]

    def hits(
        self, kind: int, passes: Passes | None = None, words: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, ...]:
        """Text, number, core, begin and end of what goes with it, of every n-gram of a kind that passes.

        With an n-gram of the last kinds, of which only those around ``words`` are looked at, goes what
        stands around it, to the ends of the words that it begins and ends in, ``REACH`` bytes at most;
        nothing with the others, whose core is their own number.
        """
        n, spaces = len(self.data), self._spaces
        if around := kind >= FIRST_AROUND:
            word, core = words or self.words(passes)
            left, right = AROUND_WORD[kind - FIRST_AROUND]
            start, end = spaces[word] - left, spaces[word + 1] + 1 + right
        elif kind < len(ANYWHERE):
            start = np.arange(n)
            end = start + ANYWHERE[kind]
        else:
            start = spaces + 1
            end = start + BEHIND_SPACE[kind - len(ANYWHERE)]
        at = np.flatnonzero((start >= 0) & (end <= n))
        start, end = start[at], end[at]
        gram = self.hash(start, end, kind)
        if passes:
            kept = passes(gram)
            at, start, end, gram = at[kept], start[kept], end[kept], gram[kept]
        # The white space that it stands behind is of the same text.
        text = np.searchsorted(self.bounds, start - (len(ANYWHERE) <= kind < FIRST_AROUND), "right") - 1
        first, last = self.bounds[text], self.bounds[text + 1]
        kept = np.flatnonzero(end <= last)
        text, gram, at, start, end, first, last = (a[kept] for a in (text, gram, at, start, end, first, last))
        if not around:
            return text, gram, gram, start, start
        word, core = word[at], core[at]
        before = np.where(word > 0, spaces[word - 1] + 1, 0)
        behind = np.where(word + 2 < len(spaces), spaces[np.minimum(word + 2, len(spaces) - 1)], n)
        low = np.minimum(start, np.maximum.reduce([before, first, start - REACH]))
        high = np.maximum(end, np.minimum.reduce([behind, last, end + REACH]))
        return text, gram, core, low, high

    def bytes_of(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of many ranges one behind the other, and their offsets."""
        offsets = np.concatenate([[0], np.cumsum(high - low)])
        places = np.arange(offsets[-1]) + np.repeat(low - offsets[:-1], high - low)
        return self.data[places], offsets


def slices(texts: pa.Array) -> Iterator[tuple[int, Slice]]:
    """Texts (strings or bytes; null counts as empty) in slices, with the number of the first one."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else [0]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        yield first, Slice(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
        first = end


def in_bitmap(bitmap: bytes) -> Passes:
    """Tells which n-grams have all their places set."""
    table = np.frombuffer(bitmap, np.uint8)
    mask = np.uint64(8 * len(table) - 1)

    def passes(gram: np.ndarray) -> np.ndarray:
        kept = None
        for i in range(PLACES):
            place = (gram if kept is None else gram[kept]) >> np.uint64(PLACE_SHIFT * i) & mask
            found = np.flatnonzero(table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
            kept = found if kept is None else kept[found]
        return kept

    return passes


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Rows that differ from the one before in one of the columns; the first does."""
    changed = np.ones(len(columns[0]), bool)
    changed[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return changed


def grams_of_texts(part: Slice, kinds: list[int], passes: Passes | None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text, number and, as a list, the different surroundings of each different n-gram of a text."""
    words = part.words(passes) if kinds[-1] >= FIRST_AROUND else None
    found = [part.hits(kind, passes, words) for kind in kinds]
    text, gram, _, low, high = (np.concatenate(c) for c in zip(*found, strict=True))
    seen = part.hash(low, high, N_KINDS)
    order = np.lexsort((seen, gram, text))
    text, gram, low, high, seen = (a[order] for a in (text, gram, low, high, seen))
    kept = _changes(text, gram, seen, high - low)
    again = np.flatnonzero(~kept)
    # Surroundings of one hash are compared with those before them, as they are dropped for good.
    filled = again[high[again] > low[again]]
    here, offsets = part.bytes_of(low[filled], high[filled])
    before, _ = part.bytes_of(low[filled - 1], high[filled - 1])
    if len(filled):
        kept[filled] = np.logical_or.reduceat(here != before, offsets[:-1])
    text, gram, low, high = (a[kept] for a in (text, gram, low, high))
    first = np.flatnonzero(_changes(text, gram)) if len(text) else np.empty(0, np.int64)
    data, offsets = part.bytes_of(low, high)
    values = pa.Array.from_buffers(
        pa.binary(), len(low), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(low)), pa.int32()), values)
    return text[first], gram[first].view(np.int64), lists


def text_batches(kinds: list[int], bitmap: Callable[[], bytes | None]):
    """For ``mapInArrow``: rows that end with a text to rows that end with an n-gram and its surroundings."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = bitmap()
        passes = in_bitmap(sent) if sent is not None else None
        for batch in rows:
            names = [*batch.schema.names[:-1], "gram", "around"]
            for first, part in slices(batch.column(batch.num_columns - 1)):
                text, gram, around = grams_of_texts(part, kinds, passes)
                own = [batch.column(i).take(pa.array(text + first)) for i in range(batch.num_columns - 1)]
                if len(gram):
                    yield pa.RecordBatch.from_arrays([*own, pa.array(gram), around], names=names)

    return batches


def query_batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: (query_idx, terms) to the n-grams that a query may be filed under, of its last kind.

    ``core`` is its core; ``near`` is what of a term must stand where the n-gram does, null where nothing
    goes with it; ``open`` are the places of the terms that are not inside it; ``alone``: there is no other n-gram.
    """
    for batch in rows:
        terms = batch.column(1)
        owner = np.asarray(terms.value_parent_indices())
        ends = np.searchsorted(owner, np.arange(len(terms)), "right")
        values = terms.flatten().cast(pa.large_binary())
        words, parts = values.to_pylist(), list(slices(values))
        filed = np.zeros(len(terms), bool)
        out = {"query_idx": [], "kind": [], "gram": [], "core": [], "near": [], "open": [], "alone": []}
        for kind in reversed(range(N_KINDS)):
            found: dict[int, dict[int, tuple[int, bytes]]] = {}
            for first, part in parts if not filed.all() else []:
                term, gram, core, low, high = part.hits(kind)
                query = owner[term + first]
                new = np.flatnonzero(~filed[query])
                data, offsets = part.bytes_of(low[new], high[new])
                data, offsets = data.tobytes(), offsets.tolist()
                numbers = (a[new].view(np.int64).tolist() for a in (gram, core))
                for q, g, c, a, b in zip(query[new].tolist(), *numbers, offsets[:-1], offsets[1:], strict=True):
                    found.setdefault(q, {}).setdefault(g, (c, data[a:b]))
            filed[list(found)] = True
            for q, grams in found.items():
                own = words[ends[q - 1] if q else 0 : ends[q]]
                for g, (c, near) in grams.items():
                    around = kind >= FIRST_AROUND
                    out["query_idx"].append(q)
                    out["kind"].append(kind)
                    out["gram"].append(g)
                    out["core"].append(c)
                    out["near"].append(near if around else None)
                    out["open"].append([i for i, t in enumerate(own) if not around or t not in near])
                    out["alone"].append(len(grams) == 1)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(out["query_idx"], pa.int64())), pa.array(out["kind"], pa.int32()),
                pa.array(out["gram"], pa.int64()), pa.array(out["core"], pa.int64()), pa.array(out["near"], pa.binary()),
                pa.array(out["open"], pa.list_(pa.int32())), pa.array(out["alone"], pa.bool_()),
            ],
            names=list(out),
        )
