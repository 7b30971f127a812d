"""Token counts without tokens: a finite-state tokenizer that emits counts.

Method: finite-state tokenizer compilation. The pre-tokenizer is a deterministic
transducer over character classes; chunk state maps of the text stream compose
through a parallel prefix scan (``pretokens``). Inside a pre-token a second
deterministic transducer reads bytes; its transitions carry the change of the
number of tokens. Its states are made when first reached (the full machine of a
50,000-token vocabulary is too large to lay out ahead) and dropped when there are
more than ``STATES``, so memory is bounded.

State of the second transducer after reading a prefix of a pre-token: the longest
suffix that starts some token (a node of an Aho-Corasick trie) and, for every
suffix on that node's failure chain, the last token of the encoding before that
suffix with its count relative to now. The encoding of a prefix ends with the one
token t among its suffixes whose seam with the encoding before t holds; so the
state decides the next one, and one byte changes the count by a number known per
transition.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import pretokens, vocab

STATES = 300_000
PAIRS = 400_000


class CountTransducer:
    def __init__(self, data: bytes):
        self.vocab = v = vocab.vocabulary(data)
        usable = set(v.self_encoding())
        #: The trie: children per node, token that ends at a node, failure chains.
        self.child: list[dict[int, int]] = [{}]
        self.token, self.parent = [-1], [0]
        for b, i in v.id_of.items():
            if i not in usable:
                continue
            node = 0
            for x in b:
                nxt = self.child[node].get(x)
                if nxt is None:
                    nxt = self.child[node][x] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                    self.parent.append(node)
                node = nxt
            self.token[node] = i
        self.fail = [0] * len(self.child)
        todo = deque(self.child[0].values())
        while todo:
            node = todo.popleft()
            for x, c in self.child[node].items():
                f = self.fail[node]
                while f and x not in self.child[f]:
                    f = self.fail[f]
                self.fail[c] = self.child[f].get(x, 0)
                todo.append(c)
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        #: state * 256 + byte -> next state * 1024 + change of the count + 512
        self.next: dict[int, int] = {}
        self.states = [(0, ((0, (-1, 0)),))]
        self.index: dict = {self.states[0]: 0}

    def _state(self, key: tuple) -> int:
        at = self.index.get(key)
        if at is None:
            at = self.index[key] = len(self.states)
            self.states.append(key)
        return at

    def _fits(self, before: int, token: int) -> bool:
        if before < 0:
            return True
        pair = before << 32 | token
        ok = self.pairs.get(pair)
        if ok is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            ok = self.pairs[pair] = self.vocab.compatible(before, token)
        return ok

    def _make(self, state: int, x: int) -> int:
        """The transition of ``state`` on byte ``x``."""
        node, seen = self.states[state][0], dict(self.states[state][1])
        deepest, found, w = 0, None, node
        while True:
            c = self.child[w].get(x)
            if c is not None:
                deepest = deepest or c
                if found is None and self.token[c] >= 0:
                    before, rel = seen[w]
                    if self._fits(before, self.token[c]):
                        found = (self.token[c], rel + 1)
            if w == 0:
                break
            w = self.fail[w]
        token, delta = found
        while deepest and not self.child[deepest]:  # nothing longer starts like this
            deepest = self.fail[deepest]
        now = []
        y = deepest
        while y:
            before, rel = seen[self.parent[y]]
            now.append((y, (before, rel - delta)))
            y = self.fail[y]
        now.append((0, (token, 0)))
        step = self.next[state << 8 | x] = self._state((deepest, tuple(now))) << 10 | delta + 512
        return step

    def count(self, word: bytes) -> int:
        if len(self.states) > STATES:
            self._reset()
        state, n = 0, 0
        for x in word:
            step = self.next.get(state << 8 | x)
            if step is None:
                if len(self.states) > 2 * STATES:  # a very long word: keep its state only
                    here = self.states[state]
                    self._reset()
                    state = self._state(here)
                step = self._make(state, x)
            state = step >> 10
            n += (step & 1023) - 512
        return n

    def words(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens of each word, one value each)."""
        return np.fromiter(map(self.count, words.to_pylist()), np.int32, len(words)), np.ones(len(words), np.int64)


def memo(data: bytes) -> pretokens.WordMemo:
    def build():
        t = CountTransducer(data)
        return pretokens.WordMemo(t.words, t.vocab.added, added_value=lambda i: 1)

    return vocab.held(("counts", vocab.digest(data)), build)


def per_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of each text's values."""
    upto = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return np.diff(upto[np.concatenate(([0], np.cumsum(sizes)))])


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 512, text: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) plus ``n_bytes`` (UTF-8),
    ``n_tokens`` (as the tokenizers library counts, without special tokens added)
    and ``over_limit`` (more tokens than ``limit``).

    A null or empty text counts zero; a text of any length is counted whole, in pieces cut
    between pre-tokens. An empty table gives no rows. Repeated rows give repeated results; a kept
    column whose name is one of the new ones is replaced. No shuffle.
    """
    new = ["n_bytes", "n_tokens", "over_limit"]
    keep = [c for c in (docs.columns if keep is None else keep) if c != text and c not in new]
    data = vocab.broadcast_file(docs.sparkSession, path)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + ["n_bytes bigint", "n_tokens bigint", "over_limit boolean"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = memo(data.value)
        for batch in parts:
            column = batch.column(batch.num_columns - 1)
            n = np.concatenate([per_text(values, sizes) for _, _, values, sizes in pretokens.encoded(counts, column)] or [np.zeros(0, np.int64)])
            size = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(keep))] + [pa.array(size), pa.array(n), pa.array(n > limit)],
                names=keep + new)

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(pretokens.unused(docs))).mapInArrow(run, schema)
