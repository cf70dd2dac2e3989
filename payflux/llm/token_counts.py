"""Operator 10: token counts by a linear longest-match automaton.

The vocabulary is a trie over the byte alphabet. Where the longest match ends,
a failure link leads to the node of what is left after the pieces that greedy
matching would pop, and the number of popped pieces is stored with the link. A
word is read once, byte by byte, and only the counts are added: no piece is built.

Defined results: a null or empty text, or one of white space only, has no words
and no tokens; repeated rows count each; long texts are counted word by word; extra
columns are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct words whose counts a worker remembers.
WORDS_KEPT = 500_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, as letter to byte.

    Printable bytes stand for themselves; the others are the letters from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> list[tuple[int, ...]]:
    """Pieces of a word-end vocabulary as symbols: bytes 0 to 255, and 256 for the end of a word."""
    letters = byte_letters()
    out = []
    for piece in json.load(open(path, encoding="utf-8"))["model"]["vocab"]:
        ended = piece.endswith("</w>")
        body = piece[:-4] if ended else piece
        if all(c in letters for c in body) and (body or ended):
            out.append((*[letters[c] for c in body], *([256] if ended else [])))
    return out


class Automaton:
    """Trie with failure links and popped counts over pieces (tuples of symbols).

    Every single symbol that can occur is made a piece, so that any word can be
    matched; the end of a word alone counts as no token.
    """

    END = 256

    def __init__(self, pieces: list[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        piece = [False]

        def add(p: tuple[int, ...]) -> None:
            at = 0
            for s in p:
                to = self.next[at].get(s)
                if to is None:
                    to = self.next[at][s] = len(self.next)
                    self.next.append({})
                    piece.append(False)
                at = to
            piece[at] = True

        for p in pieces:
            add(p)
        for b in range(257):
            add((b,))
        # in order of depth: where matching fails at a node, pop its longest piece and go on with the rest
        n = len(self.next)
        self.fail, self.popped, cost = [-1] * n, [0] * n, [1] * n
        cost[self.next[0][self.END]] = 0
        level = [(0, s, v) for s, v in self.next[0].items()]
        while level:
            below = []
            for u, s, v in level:
                if piece[v]:
                    self.fail[v], self.popped[v] = 0, cost[v]
                else:
                    z, k = self.fail[u], self.popped[u]
                    while z >= 0 and s not in self.next[z]:
                        k += self.popped[z]
                        z = self.fail[z]
                    self.fail[v], self.popped[v] = (self.next[z][s], k) if z >= 0 else (-1, k)
                below += [(v, t, x) for t, x in self.next[v].items()]
            level = below

    def count(self, word: bytes) -> int:
        """Pieces that greedy longest matching cuts the word (and its end) into."""
        at, n = 0, 0
        nxt, fail, popped = self.next, self.fail, self.popped
        for s in word:
            while s not in nxt[at]:
                n += popped[at]
                at = fail[at]
            at = nxt[at][s]
        while self.END not in nxt[at]:
            n += popped[at]
            at = fail[at]
        at = nxt[at][self.END]
        while at:
            n += popped[at]
            at = fail[at]
        return n


class Counts(dict):
    """Counts by word, remembered per worker; a missing word is counted by the automaton."""

    _held: dict[str, "Counts"] = {}

    def __init__(self, path: str):
        super().__init__()
        self.automaton = Automaton(vocabulary(path))

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        n = self[word] = self.automaton.count(word)
        return n

    @classmethod
    def of(cls, path: str) -> "Counts":
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]


OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counts = Counts.of(path)
    for batch in batches:
        words, tokens = [], []
        for i in range(0, batch.num_rows, 256):
            for t in batch.column(1).slice(i, 256).to_pylist():
                line = (t or "").encode().lower().split()
                words.append(len(line))
                tokens.append(sum(map(counts.__getitem__, line)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], schema=OUT)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words and greedy word pieces of every text: id, n_words, n_tokens.

    Words are runs of bytes other than ASCII white space, A to Z in lower case;
    each is matched from its start, with the end of the word as a last symbol.
    """
    out = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).mapInArrow(
        partial(_count, path=path), "id bigint, n_words bigint, n_tokens bigint")
    return out.withColumnRenamed("id", id_col)
