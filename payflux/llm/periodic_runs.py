"""Operator 12: runs of periodically repeated words, found in the suffix array of each text.

A run is a stretch of consecutive words of one text with smallest period q (words q
apart are identical) and at least ``max(least, repeats * q)`` words that no neighbouring
word extends. From every run its first q words stay and the rest is dropped.

The texts of a batch stand in one line of numbers, one number per distinct word of one
text, so that no match crosses from text to text. Prefix doubling sorts its suffixes; only
suffixes that are still equal are sorted again, and the ranks of every round are kept. From
the ranks follow the LCP of neighbours in the suffix array and, with a table of range
minima, the LCP intervals as pairs of bounds (no tree). In an interval of depth d every
child but the largest is walked through: if the suffix d words after or before one of its
suffixes lies in the same interval (by the inverse suffix array) but in another child, the
two agree in exactly d words, a square of period d that cannot be moved to the right (a
branching tandem repeat). Walking only the smaller children makes it n log n checks. Every
run of at least two periods ends in such a square; rotated to the left as far as the words
agree (by the kept ranks) it is the whole run. Runs over the same words are merged into the
one of smallest period.

A text is one task's work, batch by batch of about ``_BYTES`` bytes; a longer text stands
alone, with about 200 bytes of memory per word. Texts are not compared with each other, so
nothing is shuffled.

Defined results: a null or empty text has no words and no runs (digest of the empty
string); rows are judged one by one, so repeated rows and null ids stay as they are;
equally strong runs go by smallest start, then period; very long texts are judged whole; an
empty table gives no rows. The input's columns stay, whatever their names; a column named
like one of the results is replaced by it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from payflux.llm.common import slices

_BYTES = 2 << 20
_AT_ONCE = 1 << 20  # suffixes of children walked through at a time

RESULTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n_runs", "start", "length", "period", "exponent_milli")]
                       + [T.StructField(c, T.StringType()) for c in ("runs_sha256", "collapsed_sha256")])


class Suffixes:
    """Suffix array of a line of numbers, its inverse, and the ranks of prefixes of 1, 2, 4, ... numbers."""

    def __init__(self, line: np.ndarray):
        n = len(line)
        order = np.argsort(line, kind="stable")
        rank, open_ = self._groups(line[order], np.arange(n), order, np.empty(n + 1, dtype=np.int32))
        rank[n] = -1
        self.ranks, width = [rank], 1
        while len(open_):
            # the suffixes of groups of several, by the rank of what follows the equal part
            at = order[open_]
            follow = np.minimum(at + width, n)
            key = rank[at].astype(np.int64) * (n + 1) + rank[follow] + 1
            by = np.argsort(key, kind="stable")
            order[open_] = at[by]
            rank, open_ = self._groups(key[by], open_, at[by], rank.copy())
            self.ranks.append(rank)
            width *= 2
        self.order = order
        self.inverse = self.ranks[-1][:n]

    @staticmethod
    def _groups(key: np.ndarray, slots: np.ndarray, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank suffixes ``at`` in ``slots``, sorted by ``key``, by their group's first slot; the slots of groups of several."""
        if not len(key):
            return rank, slots
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        rank[at] = np.repeat(slots[first], size)
        return rank, slots[np.repeat(size > 1, size)]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers agree from the places ``a`` and ``b`` on (a != b)."""
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            same = np.where(self.ranks[k][a] == self.ranks[k][b], 1 << k, 0)
            n += same
            a += same
            b += same
        return n

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers agree before the places a < b."""
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            w = 1 << k
            same = np.where((a >= w) & (self.ranks[k][np.maximum(a - w, 0)] == self.ranks[k][np.maximum(b - w, 0)]), w, 0)
            n += same
            a -= same
            b -= same
        return n

    def lcp(self) -> np.ndarray:
        """LCP of every suffix in the array with the one before it."""
        out = np.zeros(len(self.order), dtype=np.int32)
        first = self.ranks[0][self.order]
        some = np.flatnonzero(first[1:] == first[:-1]) + 1
        out[some] = self.ahead(self.order[some], self.order[some - 1])
        return out


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per inner boundary of the LCP intervals (depth above 0), sorted by interval: the boundary, the interval's first and last place, its depth."""
    n = len(lcp)
    at = np.flatnonzero(lcp > 0)
    depth = lcp[at]
    widest = int(np.diff(np.flatnonzero(np.append(lcp == 0, True)), prepend=-1).max(initial=1))
    low, least = [lcp], lcp
    while 1 << len(low) <= widest:
        half = 1 << (len(low) - 1)
        least = np.minimum(least[:len(least) - half], least[half:])
        low.append(least)
    left, right = at.copy(), at + 1
    for k in range(len(low) - 1, -1, -1):
        w = 1 << k
        ok = left >= w
        ok[ok] = low[k][left[ok] - w] >= depth[ok]
        left[ok] -= w
        ok = right + w <= n
        ok[ok] = low[k][right[ok]] >= depth[ok]
        right[ok] += w
    left, right = left - 1, right - 1
    by = np.argsort(left * n + right, kind="stable")
    return at[by], left[by], right[by], depth[by]


def _smaller_children(lcp: np.ndarray, words: np.ndarray, order: np.ndarray, repeats: int) -> tuple[np.ndarray, ...]:
    """First place, last place, interval's first and last place, depth of all children but the largest of every interval."""
    at, left, right, depth = intervals(lcp)
    # a run of this period must fit into the text
    fits = repeats * depth.astype(np.int64) <= words[order[left]]
    at, left, right, depth = at[fits], left[fits], right[fits], depth[fits]
    if not len(at):
        return (at,) * 5
    new = np.ones(len(at), dtype=bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    first = np.flatnonzero(new)
    inner = np.diff(np.append(first, len(at)))  # boundaries in each interval; one more children
    begin = np.insert(at, first, left[first])
    which = np.repeat(np.arange(len(first)), inner + 1)
    end = np.append(begin[1:], 0)
    closes = np.cumsum(inner + 1) - 1
    end[closes] = right[first] + 1
    size = end - begin
    tops = np.lexsort((-size, which))[np.append(0, closes[:-1] + 1)]
    rest = np.ones(len(begin), dtype=bool)
    rest[tops] = False
    which = which[rest]
    return begin[rest], end[rest] - 1, left[first][which], right[first][which], depth[first][which]


def squares(line: np.ndarray, words: np.ndarray, repeats: int) -> tuple[Suffixes, np.ndarray, np.ndarray]:
    """The suffixes, and start and period of every square that cannot be moved to the right; ``words``: length of each place's text."""
    suffixes = Suffixes(line)
    order, inverse, n = suffixes.order, suffixes.inverse, len(line)
    begin, end, left, right, depth = _smaller_children(suffixes.lcp(), words, order, repeats)
    starts, periods = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    size = end - begin + 1
    upto = np.cumsum(size)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + _AT_ONCE, side="right")))
        s = size[i:j]
        child = np.repeat(np.arange(i, j), s)
        place = np.arange(len(child)) - np.repeat(np.cumsum(s) - s, s) + begin[child]
        at, d = order[place], depth[child].astype(np.int64)
        for move in (d, -d):
            other = at + move
            ok = np.flatnonzero((other >= 0) & (other < n))
            where, c = inverse[other[ok]], child[ok]
            ok = ok[(where >= left[c]) & (where <= right[c]) & ((where < begin[c]) | (where > end[c]))]
            starts.append(np.minimum(at[ok], other[ok]))
            periods.append(d[ok])
        i = j
    return suffixes, np.concatenate(starts), np.concatenate(periods)


def runs_of(texts: list[list[bytes]], least: int = 24, repeats: int = 3) -> list[list[tuple[int, int, int]]]:
    """Per text (a list of words) its runs (start, length, period), by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    number = count()
    lines = []
    for words in texts:
        known: defaultdict[bytes, int] = defaultdict(number.__next__)
        lines.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
    n = np.array([len(w) for w in texts], dtype=np.int64)
    if not n.sum():
        return out
    first = np.cumsum(n) - n
    suffixes, start, period = squares(np.concatenate(lines), np.repeat(n, n), repeats)
    back = suffixes.behind(start, start + period)
    start, length = start - back, back + 2 * period
    ok = length >= np.maximum(least, repeats * period)
    start, length, period = start[ok], length[ok], period[ok]
    text = np.searchsorted(first, start, side="right") - 1
    last = None
    for k in np.lexsort((period, length, start)):
        now = (int(start[k]), int(length[k]))
        if now != last:  # of runs over the same words the one of smallest period
            out[text[k]].append((int(start[k] - first[text[k]]), int(length[k]), int(period[k])))
        last = now
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the repetition that the query's contract writes into a tenth of the documents."""
    n = len(words)
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def summary(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The result's columns for one text."""
    best: tuple = (None, None, None, None)
    kept = words
    if runs:
        s, n, q = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
        best = (s, n, q, 1000 * n // q)
        stay = np.ones(len(words), dtype=bool)
        for s, n, q in runs:
            stay[s + q:s + n] = False
        kept = [w for w, k in zip(words, stay) if k]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    return (len(runs), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, repeats: int = 3, plant: bool = False) -> DataFrame:
    """``docs`` without the text, with the runs of its words: their number, the strongest one and digests of all runs and of the text without repetitions.

    ``plant`` first writes the contract's repetitions into the texts (``planted``).
    """
    stay = [f for f in docs.schema.fields if f.name != text_col and f.name not in RESULTS.names]
    wanted = list(dict.fromkeys([f.name for f in stay] + [text_col] + ([id_col] if plant else [])))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, _BYTES):
                texts = [[] if t is None else t.encode().split() for t in part.column(text_col).to_pylist()]
                if plant:
                    texts = [planted(w, i) for w, i in zip(texts, part.column(id_col).to_pylist())]
                rows = [summary(w, r) for w, r in zip(texts, runs_of(texts, least, repeats))]
                columns = [pa.array(c, type=pa.int64() if k < 5 else pa.string()) for k, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in stay], *columns], names=[f.name for f in stay] + RESULTS.names)

    return docs.select(*[f"`{c}`" for c in wanted]).mapInArrow(judged, T.StructType(stay + RESULTS.fields))
