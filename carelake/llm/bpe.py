"""BPE encoding and decoding.

Method: a backtracking encoder. Within a pre-token, an Aho-Corasick automaton
over all token bytes gives the longest token starting at each position. The
encoder takes the longest token at the current position if it is compatible with
the token before it (a pair-compatibility table, filled on demand from the merge
ranks: a pair is compatible if no merge would have crossed its seam); otherwise
it tries the next shorter token, and when none is left it drops the previous
token and marks the position as a dead end, so no position is entered twice after
failing: linear time, exactly the merges' result. Decoding gathers token bytes
through an offset table.

All distinct pre-tokens of a slice that the worker's memo does not know are encoded together, one
step of each at a time, on flat tables that the workers of an executor map from one file
(``flat``). Rows stay where they are: no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import flat, pretokens, vocab

PAIR_BITS = 18  # places of the compatibility table; a place keeps the last pair that fell on it
SEGMENT = 512  # bytes of a word read in one go; longer words are read in parts with a lead-in
BATCH = 1 << 20  # bytes of words encoded together


class Encoder:
    """Encodes many words at once on the arrays of ``flat.compiled``."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.__dict__.update(tables)
        self.lead = int(self.length.max()) - 1
        # In one step two parts of a word lie further apart than any token is long.
        self.segment = max(SEGMENT, 3 * self.lead)
        self.pair = np.full(1 << PAIR_BITS, -1, np.int64)
        self.fits = np.zeros(1 << PAIR_BITS, bool)

    # --- the automaton --------------------------------------------------------------------

    def _goto(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next state of each: the transition of the nearest state on the failure chain that has one."""
        key = state.astype(np.int64) << 8 | byte
        at = flat._find(self.goto_key, key)
        out = np.where(at >= 0, self.goto_to[at], 0)
        todo = np.flatnonzero((at < 0) & (state != 0))
        back = state[todo]
        while len(todo):
            back = self.fail[back]
            at = flat._find(self.goto_key, back.astype(np.int64) << 8 | byte[todo])
            hit = at >= 0
            out[todo[hit]] = self.goto_to[at[hit]]
            on = ~hit & (back != 0)
            todo, back = todo[on], back[on]
        return out

    def longest(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The longest token that starts at each byte of the words ``data[begin:end]``."""
        # Parts of ``segment`` bytes; a state depends on the last ``lead`` bytes only, so a part that
        # starts inside a word reads those first.
        parts = np.maximum(1, -(-(end - begin) // self.segment))
        word = np.repeat(np.arange(len(begin)), parts)
        own = begin[word] + self.segment * (np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts))
        first, last = np.maximum(begin[word], own - self.lead), np.minimum(end[word], own + self.segment)
        by = np.argsort(first - last, kind="stable")  # longest first: those still running lie in front
        first, own, size = first[by], own[by], (last - first)[by]
        found = np.full(len(data), -1, np.int32)
        state = np.zeros(len(by), np.int32)
        running = len(by) - np.searchsorted(size[::-1], np.arange(int(size[0]) if len(size) else 0), side="right")
        for j, m in enumerate(running.tolist()):
            at = first[:m] + j
            state = self._goto(state[:m], data[at])
            which = np.flatnonzero(at >= own[:m])
            node = self.out[state[which]]
            while True:  # all tokens that end here: nodes along the failure chain
                live = node > 0
                if not live.all():
                    which, node = which[live], node[live]
                if not len(node):
                    break
                t = self.token[node]
                start = at[which] - self.length[t] + 1
                better = (found[start] < 0) | (self.length[found[start]] < self.length[t])
                found[start[better]] = t[better]
                node = self.out[self.fail[node]]
        return found

    # --- pairs ----------------------------------------------------------------------------

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the tokens of each pair stay next to each other as they are (see ``Vocabulary.compatible``)."""
        out, todo = np.ones(len(a), bool), np.arange(len(a))
        until_a = np.full(len(a), 1 << 30, np.int64)
        until_b = until_a.copy()
        while len(todo):
            at = flat._find(self.merge_key, a.astype(np.int64) << 32 | b)
            rank = self.merge_rank[at]
            broken = (at >= 0) & (rank < until_a) & (rank <= until_b)
            out[todo[broken]] = False
            fa, fb = self.rank[a], self.rank[b]
            on = ~broken & ((fa >= 0) | (fb >= 0))
            todo, a, b, fa, fb, until_a, until_b = (x[on] for x in (todo, a, b, fa, fb, until_a, until_b))
            undo_a = fa > fb  # a token that was never formed has rank -1
            until_a, until_b = np.where(undo_a, fa, until_a), np.where(undo_a, until_b, fb)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_compatible`` by way of the table."""
        key = a.astype(np.int64) << 32 | b
        place = flat._place(key, PAIR_BITS)
        known = self.pair[place] == key
        out = self.fits[place]
        if not known.all():
            new, which = np.unique(key[~known], return_inverse=True)
            ok = self._compatible(new >> 32, new & 0xFFFFFFFF)
            out[~known] = ok[which]
            at = flat._place(new, PAIR_BITS)
            self.pair[at] = new
            mine = self.pair[at] == new  # of the new pairs that share a place, the one that stayed
            self.fits[at[mine]] = ok[mine]
        return out

    # --- backtracking ---------------------------------------------------------------------

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words laid end to end, number of ids of each) for non-empty words
        ``data[offsets[i]:offsets[i + 1]]``."""
        begin, end = offsets[:-1], offsets[1:]
        longest = self.longest(data, begin, end)
        token = np.full(len(data), -1, np.int32)  # the token taken at a position
        before = np.zeros(len(data) + 1, np.int64)  # where the token that ends at a position starts
        dead = np.zeros(len(data) + 1, bool)
        pos, stop, first = begin.astype(np.int64), end.astype(np.int64), begin.astype(np.int64)
        t = longest[pos]
        while len(pos):
            if len(pos) <= 4:
                for k in range(len(pos)):
                    self._alone(int(pos[k]), int(first[k]), int(stop[k]), int(t[k]), longest, token, before, dead)
                break
            to = pos + self.length[t]
            ok = t >= 0
            ok &= ~dead[np.where(ok, to, 0)] | (to == stop)
            seam = np.flatnonzero(ok & (pos != first))
            if len(seam):
                ok[seam] = self.compatible(token[before[pos[seam]]], t[seam])
            # Take the token where it fits.
            token[pos[ok]] = t[ok]
            before[to[ok]] = pos[ok]
            # Where no shorter one is left, drop the token before and try its next shorter one.
            last = np.flatnonzero(~ok & (t < 0))
            dead[pos[last]] = True
            nxt = np.where(ok, to, pos)
            nxt[last] = before[pos[last]]
            more = nxt != stop
            t = np.where(ok, longest[np.where(more, nxt, 0)], self.shorter[t])
            t[last] = self.shorter[token[nxt[last]]]
            pos, stop, first, t = nxt[more], stop[more], first[more], t[more]
        # Follow the tokens from each word's start.
        chain, owner, pos, word = [], [], begin.astype(np.int64), np.arange(len(begin))
        while len(pos):
            chain.append(pos)
            owner.append(word)
            nxt = pos + self.length[token[pos]]
            on = nxt < end[word]
            pos, word = nxt[on], word[on]
            if 0 < len(pos) <= 4:
                for p, w in zip(pos.tolist(), word.tolist()):
                    rest, stop_ = [], int(end[w])
                    while p < stop_:
                        rest.append(p)
                        p += int(self.length[token[p]])
                    chain.append(np.array(rest))
                    owner.append(np.full(len(rest), w))
                break
        at = np.sort(np.concatenate(chain)) if chain else np.zeros(0, np.int64)
        n = np.bincount(np.concatenate(owner), minlength=len(begin)) if owner else np.zeros(len(begin), np.int64)
        return token[at], n

    def _alone(self, pos: int, first: int, stop: int, t: int, longest, token, before, dead) -> None:
        """The same steps for one word: the last few of a batch are long."""
        length, shorter = self.length, self.shorter
        known: dict[tuple[int, int], bool] = {}
        while pos < stop:
            while t >= 0:
                to = pos + int(length[t])
                if to == stop or not dead[to]:
                    if pos == first:
                        break
                    pair = (int(token[before[pos]]), t)
                    if pair not in known:
                        if len(known) > 1 << 16:
                            known.clear()
                        known[pair] = bool(self.compatible(np.array([pair[0]]), np.array([t]))[0])
                    if known[pair]:
                        break
                t = int(shorter[t])
            if t >= 0:
                token[pos], before[to] = t, pos
                pos = to
                t = int(longest[pos]) if pos < stop else -1
            else:
                dead[pos] = True
                pos = int(before[pos])
                t = int(shorter[token[pos]])

    def words(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words laid end to end, number of ids of each), a bounded batch of bytes at a time."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2], np.uint8)
        values, sizes, i = [], [], 0
        while i < len(words):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BATCH, side="right")) - 1)
            v, n = self.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            values.append(v)
            sizes.append(n)
            i = j
        return np.concatenate(values), np.concatenate(sizes)


class Decoder:
    """Token bytes laid end to end, with an offset table by id."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.offsets, self.table = tables["offsets"], tables["bytes"]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, where each id's bytes start and, last, end)."""
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        total = np.concatenate(([0], np.cumsum(size)))
        return self.table[np.repeat(start - total[:-1], size) + np.arange(total[-1])], total

    def text(self, ids: np.ndarray) -> str:
        """As the library decodes: invalid byte sequences become U+FFFD."""
        return self.decode(ids)[0].tobytes().decode("utf-8", "replace")


def tools(shipped: flat.Shipped) -> tuple[pretokens.WordMemo, Decoder]:
    def build():
        tables = shipped.load()
        return pretokens.WordMemo(Encoder(tables).words, shipped.added, classes=tables["classes"]), Decoder(tables)

    return vocab.held(("bpe", shipped.key), build)


def encode_decode(docs: DataFrame, path: str | None = None, text: str = "text", keep: list[str] | None = None,
                  ids: bool = True) -> DataFrame:
    """Adds ``ids`` (array<int>), ``n_tokens``, ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers) and ``decoded_sha256`` (of the decoded
    text in UTF-8) to the columns ``keep`` (default: all but the text).

    A null or empty text has no ids; a text of any length is encoded whole, in pieces cut between
    pre-tokens. Rows are independent: repeated rows give repeated results, an empty table
    none. A kept column whose name is one of the new ones is replaced.
    """
    new = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    keep = [c for c in (docs.columns if keep is None else keep) if c != text and c not in new]
    shipped = flat.ship(docs.sparkSession, path)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + ["ids array<int>"] * ids + ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, decoder = tools(shipped)
        for batch in parts:
            for i, j, values, sizes in pretokens.encoded(memo, batch.column(len(keep))):
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                raw = memoryview(np.ascontiguousarray(values, "<u4")).cast("B")
                back, at = decoder.decode(values)
                back, at = memoryview(back), at[bounds].tolist()
                sha = [hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                # Invalid byte sequences become U+FFFD, as the library decodes.
                decoded = [hashlib.sha256(bytes(back[a:b]).decode("utf-8", "replace").encode()).hexdigest() for a, b in zip(at, at[1:])]
                cols = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.astype(np.int32))))
                cols += [pa.array(sizes, pa.int64()), pa.array(sha, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=keep + ["ids"] * ids + new[1:])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(pretokens.unused(docs))).mapInArrow(run, schema)
