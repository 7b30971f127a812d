"""Pre-tokens of whole texts by a finite-state transducer, many texts at once.

The byte-level pre-tokenizer's pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

is compiled by hand into a deterministic transducer over character classes. A
transition emits where a pre-token starts: at the character just read and / or
(where the pattern looks ahead) at the one before it. Texts are joined into one
stream with an END symbol after each. The stream is cut into chunks of equal
length; each chunk's state map (entry state -> exit state) is found for all
entry states at once, the maps are composed by a parallel prefix scan
(log2(chunks) rounds), and with every chunk's entry state known the starts are
emitted in one more pass over all chunks together.

Words are then put into a dictionary by their bytes, and looked up by their bytes in a worker's
memo, so that an encoder runs once per distinct word of the memo; the memo is
bounded by the bytes it holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END, SP, WS, LETTER, NUMBER, APOS, C_STMD, C_RV, C_L, C_E, OTHER = range(11)
N_CLASSES = 11
START, W1S, W1O, WNS, WNO, LET, NUM, OTH, AP, APR, APL = range(11)
N_STATES = 11
HERE, BEFORE = 1, 2  # emitted: a pre-token starts at this character / at the one before

PIECE = 1 << 20  # bytes of text joined into one stream, about
CHUNK = 256
MEMO_BYTES = 64 << 20  # of a memo's words and values, about
BLOCKS = 4  # words of up to 8 * BLOCKS bytes are kept in rows of 8-byte blocks, longer ones as objects


def _begin(c: int) -> int:
    return {END: START, SP: W1S, WS: W1O, NUMBER: NUM, APOS: AP, OTHER: OTH}.get(c, LET)


def _step(state: int, c: int) -> tuple[int, int]:
    letter = c in (LETTER, C_STMD, C_RV, C_L, C_E)
    white = c in (SP, WS)
    if state == LET:
        return (LET, 0) if letter else (_begin(c), HERE)
    if state == NUM:
        return (NUM, 0) if c == NUMBER else (_begin(c), HERE)
    if state == OTH:
        return (OTH, 0) if c in (OTHER, APOS) else (_begin(c), HERE)
    if state in (W1S, W1O, WNS, WNO):
        if white:
            return (WNS if c == SP else WNO), 0
        if c == END:
            return START, HERE
        # The last white character of a longer run belongs to what follows (a
        # space) or stands alone (any other).
        late = BEFORE if state in (WNS, WNO) else 0
        if state in (W1S, WNS):
            return (OTH if c in (OTHER, APOS) else _begin(c)), late
        return _begin(c), late | HERE
    if state == AP:
        if c == C_STMD:
            return START, 0
        if c in (C_RV, C_L):
            return (APR if c == C_RV else APL), 0
        return (OTH, 0) if c in (OTHER, APOS) else (_begin(c), HERE)
    if state in (APR, APL):
        if c == (C_E if state == APR else C_L):
            return START, 0
        nxt, out = _step(LET, c)
        return nxt, out | BEFORE
    return _begin(c), HERE


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each code point, next state, emission); the latter two are flat,
    indexed by class * N_STATES + state."""
    nxt = np.zeros(N_CLASSES * N_STATES, np.uint8)
    out = np.zeros(N_CLASSES * N_STATES, np.uint8)
    for c in range(N_CLASSES):
        for s in range(N_STATES):
            nxt[c * N_STATES + s], out[c * N_STATES + s] = _step(s, c)
    return _classes(), nxt, out


def _classes() -> np.ndarray:
    import regex
    cls = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, c in ((r"\p{White_Space}+", WS), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, points):
            a, b = ord(points[m.start()]), ord(points[m.end() - 1])
            cls[a:b + 1] = c
    cls[0xD800:0xE000] = OTHER
    for chars, c in ((" ", SP), ("'", APOS), ("stmd", C_STMD), ("rv", C_RV), ("l", C_L), ("e", C_E)):
        for ch in chars:
            cls[ord(ch)] = c
    return cls


def entry_states(cls: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The state in which each chunk of the stream is entered (parallel prefix scan)."""
    _, nxt, _ = tables()
    rows = cls.reshape(-1, chunk).T.astype(np.int32) * N_STATES  # position-major
    maps = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (rows.shape[1], N_STATES)).copy()
    settle = min(16, chunk)
    for j in range(settle):
        maps = nxt[rows[j][:, None] + maps]
    # By now nearly all chunks lead every entry state to the same one: go on with that.
    one = (maps == maps[:, :1]).all(1)
    for which, cur in ((one, maps[one, 0]), (~one, maps[~one])):
        if len(cur):
            rest = rows[settle:, which]
            for j in range(chunk - settle):
                cur = nxt[(rest[j] if cur.ndim == 1 else rest[j][:, None]) + cur]
            maps[which] = cur[:, None] if cur.ndim == 1 else cur
    # Inclusive scan: after it, maps[i] leads from the stream's start to chunk i's end.
    d = 1
    while d < len(maps):
        maps[d:] = np.take_along_axis(maps[d:], maps[:-d].astype(np.intp), axis=1)
        d *= 2
    return np.concatenate(([np.uint8(START)], maps[:-1, START]))


def starts(cls: np.ndarray) -> np.ndarray:
    """True where a pre-token (or END) starts, for a stream of character classes."""
    _, nxt, out = tables()
    n = len(cls)
    pad = -n % CHUNK
    if pad:
        cls = np.concatenate([cls, np.zeros(pad, np.uint8)])  # END
    state = entry_states(cls)
    rows = cls.reshape(-1, CHUNK).T.astype(np.int32) * N_STATES
    emitted = np.empty(rows.shape, np.uint8)
    for j in range(CHUNK):
        at = rows[j] + state
        emitted[j] = out[at]
        state = nxt[at]
    emitted = emitted.T.reshape(-1)[:n]
    here = (emitted & HERE).astype(bool)
    here[:-1] |= (emitted[1:] & BEFORE).astype(bool)
    return here


_CUT = re.compile(r"(?<=\S)[ \n]")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A long text in pieces of about ``size`` characters, cut where a white
    character follows another one: a pre-token always starts there."""
    i = 0
    while len(text) - i > size:
        m = _CUT.search(text, i + size)
        if not m:
            break
        yield text[i:m.start()]
        i = m.start()
    yield text[i:] if i else text


def split(column: pa.Array, classes: np.ndarray | None = None) -> tuple[np.ndarray, pa.BinaryArray]:
    """(pre-tokens per text, all pre-tokens as bytes) of a column of texts without nulls.

    Pre-tokens tile their text, so they share the column's bytes: only offsets are made.
    """
    texts = len(column)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + texts + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at -= at[0]
    code = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    # Where each character starts in the bytes (none needed if all are one byte long).
    place = None if len(code) == len(raw) else np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw)).astype(np.int32)
    ends = at[1:] if place is None else np.searchsorted(place, at[1:])
    cls = np.insert((tables()[0] if classes is None else classes)[code], ends, END)
    here = np.flatnonzero(starts(cls))
    is_end = cls[here] == END
    text = np.cumsum(is_end) - is_end  # the text that each start belongs to
    word = here[~is_end] - text[~is_end]  # as a character of the stream without END
    offsets = np.append(word if place is None else place[word], len(raw)).astype(np.int32)
    n = np.bincount(text[~is_end], minlength=texts)
    return n, pa.BinaryArray.from_buffers(pa.binary(), len(word), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def blocks_of(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of 8-byte blocks, padded with zeros, of the words that fit into one; length of each word)."""
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
    size, step = np.diff(at), np.arange(8 * BLOCKS, dtype=np.int32)
    rows = raw[np.minimum(at[:-1, None] + step, len(raw) - 1)]
    rows[step >= size[:, None]] = 0
    return rows.view(np.uint64), size


class WordTable:
    """Slots of distinct words, found by a hash and told apart by all of their bytes."""

    def __init__(self):
        self.rows = np.zeros((1 << 12, BLOCKS), np.uint64)
        self.size = np.zeros(1 << 12, np.int32)
        self.table = np.full(1 << 13, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.n = 0  # slots given out

    def _place(self, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
        h = size.astype(np.uint64)
        for k in range(BLOCKS):
            h = (h ^ rows[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(65 - len(self.table).bit_length())).astype(np.int64)

    def _walk(self, rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot of each word or -1, its place or the free place where the search ended)."""
        at, mask = self._place(rows, size), len(self.table) - 1
        out, todo = np.full(len(rows), -1, np.int64), np.arange(len(rows))
        while len(todo):
            there = self.table[at[todo]]
            todo, there = todo[there >= 0], there[there >= 0]
            same = (self.rows[there] == rows[todo]).all(1) & (self.size[there] == size[todo])
            out[todo[same]] = there[same]
            todo = todo[~same]
            at[todo] = (at[todo] + 1) & mask
        return out, at

    def find(self, words: pa.BinaryArray, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The slot of each word, -1 if it has none."""
        long = np.flatnonzero(size > 8 * BLOCKS)
        out, _ = self._walk(rows, size)
        if len(long):
            out[long] = [self.long.get(w, -1) for w in words.take(pa.array(long)).to_pylist()]
        return out

    def add(self, words: pa.BinaryArray, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
        """New slots, in order, for words that have none and are all different."""
        slots = np.arange(self.n, self.n + len(rows))
        self.n += len(rows)
        while self.n > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.rows[slots], self.size[slots] = rows, size
        long = size > 8 * BLOCKS
        if long.any():
            at = np.flatnonzero(long)
            self.long.update(zip(words.take(pa.array(at)).to_pylist(), slots[at].tolist()))
        if 2 * self.n > len(self.table):
            while 2 * self.n > len(self.table):
                self.table = np.full(2 * len(self.table), -1, np.int32)
            kept = np.flatnonzero(self.size[:self.n] <= 8 * BLOCKS)
            self._enter(kept)
        else:
            self._enter(slots[~long])
        return slots

    def _enter(self, slots: np.ndarray) -> None:
        mask = len(self.table) - 1
        at = self._place(self.rows[slots], self.size[slots])
        while len(slots):
            free = self.table[at] < 0
            self.table[at[free]] = slots[free]  # of several words at one free place one stays
            on = self.table[at] != slots
            slots, at = slots[on], (at[on] + 1) & mask

    def nbytes(self) -> int:
        return self.rows.nbytes + self.size.nbytes + self.table.nbytes + sum(map(len, self.long)) + 150 * len(self.long)


class WordMemo:
    """Values of distinct words, flat: word ``i`` has ``values[offsets[i]:offsets[i] + lengths[i]]``.

    ``encode(words)`` takes an array of words as bytes and gives their values laid end to end and the
    number of values of each. The memo is emptied when it holds more than ``limit`` bytes: memory
    stays bounded, results do not depend on it.
    """

    def __init__(self, encode: Callable[[pa.BinaryArray], tuple[np.ndarray, np.ndarray]], added: dict[str, int] | None = None,
                 added_value: Callable[[int], int] = lambda i: i, limit: int = MEMO_BYTES, classes: np.ndarray | None = None):
        self.encode, self.limit, self.classes = encode, limit, classes
        self.added, self.added_value = added or {}, added_value
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None
        self._clear()

    def _clear(self) -> None:
        self.table = WordTable()
        self.lengths = np.zeros(1 << 12, np.int32)
        self.offsets = np.zeros(1 << 12, np.int32)
        self.values = np.zeros(1 << 13, np.int32)
        self.used = 0

    def _put(self, slots: np.ndarray, values: np.ndarray, size: np.ndarray) -> None:
        n, total = self.table.n, len(values)
        while n > len(self.lengths):
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
        while self.used + total > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[self.used:self.used + total] = values
        self.lengths[slots] = size
        self.offsets[slots] = self.used + np.cumsum(size) - size
        self.used += total

    def nbytes(self) -> int:
        return self.table.nbytes() + self.lengths.nbytes + self.offsets.nbytes + self.values.nbytes

    def _slots(self, words: pa.BinaryArray) -> np.ndarray:
        """The slot of each of these distinct words; new ones are encoded."""
        full = self.table.n + len(words) > len(self.table.rows)  # the arrays may have to double
        if self.nbytes() * (2 if full else 1) > self.limit:
            self._clear()
        rows, size = blocks_of(words)
        slots = self.table.find(words, rows, size)
        miss = np.flatnonzero(slots < 0)
        if len(miss):
            new = words.take(pa.array(miss))
            values, n = self.encode(new)
            slots[miss] = mine = self.table.add(new, rows[miss], size[miss])
            self._put(mine, values, n)
        return slots

    def _plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(values of all texts laid end to end, number of values per text)."""
        per_text, words = split(column, self.classes)
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        d = words.dictionary_encode()
        of = self._slots(d.dictionary)[d.indices.to_numpy()]
        n = self.lengths[of]
        upto = np.cumsum(n, dtype=np.int64)
        shift = (self.offsets[of] - (upto - n)).astype(np.int32 if upto[-1] < 1 << 31 else np.int64)
        at = np.repeat(shift, n)
        at += np.arange(len(at), dtype=at.dtype)
        bounds = np.concatenate(([0], np.cumsum(per_text)))
        per = np.diff(np.concatenate(([0], upto))[bounds])
        return self.values[at], per

    def run(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(values of all texts laid end to end, number of values per text); a null text has none."""
        column = pc.fill_null(column.cast(pa.string()), "")  # 32-bit offsets, whatever the session's Arrow types
        if self.split is None or not any(pc.any(pc.match_substring(column, a)).as_py() for a in self.added):
            return self._plain(column)
        # Sections between added tokens are pre-tokenized on their own.
        parts, owner, marks = [], [], []
        for k, t in enumerate(column.to_pylist()):
            for piece in self.split.split(t):
                if piece in self.added:
                    marks.append((len(parts), self.added_value(self.added[piece])))
                    piece = ""
                parts.append(piece)
                owner.append(k)
        values, per = self._plain(pa.array(parts, pa.string()))
        if marks:
            part, one = (np.array(x) for x in zip(*marks))
            values = np.insert(values, (np.cumsum(per) - per)[part], one)
            per[part] = 1
        return values, np.bincount(owner, per, len(column)).astype(np.int64)


def unused(docs) -> str:
    """A column name that ``docs`` does not have."""
    return "_" * (1 + max(map(len, docs.columns)))


def ranges(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges (i, j) of a column of texts of about ``size`` bytes together (a longer text alone)."""
    n = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    upto, i = np.cumsum(n, dtype=np.int64), 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + size)))
        yield i, j
        i = j


def slices(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, list[str]]]:
    """``ranges`` with the texts (null: empty): a batch's texts are never all Python strings at once."""
    for i, j in ranges(column, size):
        yield i, j, [t or "" for t in column.slice(i, j - i).to_pylist()]


def encoded(memo: WordMemo, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, values of the texts i to j laid end to end, number of values of each), in order; a
    long text goes in pieces, so that memory is bounded by its own values."""
    # An added token never spans a cut: cuts are before white characters, and with
    # white characters inside added tokens the texts stay whole.
    whole = any(re.search(r"\s", a) for a in memo.added)
    for i, j in ranges(column, PIECE):
        texts = column.slice(i, j - i)
        if j == i + 1 and not whole and (pc.binary_length(texts)[0].as_py() or 0) > 2 * PIECE:
            values = np.concatenate([memo.run(pa.array([p]))[0] for p in pieces(texts[0].as_py())])
            yield i, j, values, np.array([len(values)], np.int64)
        else:
            yield i, j, *memo.run(texts)
