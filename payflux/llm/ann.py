"""Operator 5: nearest neighbours by inner product with collision-counting hashing.

Vectors are cut into blocks by their length, longest first. Within a block they get
one more component that makes all as long as the longest, so that the largest inner
product is the smallest distance. Each is projected to ``lines`` single lines, and the
projections of every line are kept as a sorted array. A query opens a window around its
own projection on every line; vectors that fall into the window on enough lines (the
collision threshold) are verified by their inner product in double precision on the
original components.

A window that is ``reach`` times as wide as a distance holds the projection of a vector
at that distance with a known probability, and ``threshold`` is the number of lines that
such a vector passes nearly always (mean less ``slack`` standard deviations). A query without k
verified vectors widens its windows step by step (virtual rehashing), from the smallest that
vectors of the block need for k neighbours of their own, until k are verified within the
distance that the windows stand for; with k verified its windows are those of the k-th best so far, and a block whose longest vector can't reach that is left out.
Windows that hold more than half of a block are counted by the vectors outside.

A task takes a block of queries through a group of up to ``_GROUP`` blocks of the index,
one after another, and sends the ``k`` best per query, which are merged. Blocks and their
rows are in the order of length and id, so a task that is run again answers alike.

Defined results: unusable vectors (null, empty, zero, null or non-finite components, a
length unlike the others') take no part, neither as query nor as candidate; a row
is no candidate for a query with its own id; repeated query rows are one query,
repeated candidates stand each; ties go to the smaller id; vectors have no texts; extra
columns are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payflux.llm.common import stored
from payflux.llm.vectors import matrix, usable

#: Blocks of the index that one task takes a block of queries through.
_GROUP = 8


@dataclass(frozen=True)
class Collisions:
    """Half a window is ``reach`` times a distance; a vector at it passes unless ``slack`` standard deviations below the mean."""

    lines: int = 128
    reach: float = 1.9
    slack: float = 1.0
    widen: float = 1.1
    block: int = 8192
    queries: int = 1024
    seed: int = 5

    @property
    def threshold(self) -> int:
        p = math.erf(self.reach / math.sqrt(2))
        return max(1, math.floor(self.lines * p - self.slack * math.sqrt(self.lines * p * (1 - p))))


def directions(dims: int, how: Collisions) -> np.ndarray:
    return np.random.default_rng(how.seed).normal(size=(dims, how.lines))


_INDEX = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("top", pa.float64()), ("ids", pa.binary()), ("vecs", pa.binary()),
                    ("vals", pa.binary()), ("ords", pa.binary())])
_INDEX_SQL = "block bigint, n int, top double, ids binary, vecs binary, vals binary, ords binary"


def _block(number: int, ids: np.ndarray, x: np.ndarray, how: Collisions) -> dict:
    """A row of the index: ids and vectors of a block, the sorted projections of every line and the rows in that order."""
    square = (x * x).sum(axis=1)
    top = math.sqrt(square.max())
    scaled = np.hstack([x / top, np.sqrt(np.maximum(0.0, 1.0 - square / top / top))[:, None]])
    p = (scaled @ directions(scaled.shape[1], how)).astype("<f4").T
    order = np.argsort(p, axis=1, kind="stable").astype("<i4")
    return {"block": number, "n": len(ids), "top": top, "ids": ids.astype("<i8").tobytes(), "vecs": x.astype("<f8").tobytes(),
            "vals": np.take_along_axis(p, order, axis=1).tobytes(), "ords": order.tobytes()}


def _index(batches: Iterator[pa.RecordBatch], how: Collisions) -> Iterator[pa.RecordBatch]:
    """The rows of a partition, sorted by length and id, in blocks of ``how.block``."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 20
    ids, xs, held = [], [], 0
    for b in batches:
        for i in range(0, b.num_rows, how.block):
            part = b.slice(i, how.block)
            ids.append(part.column("id").to_numpy())
            xs.append(matrix(part.column("vec")))
            held += part.num_rows
            while held >= how.block:
                a, x = np.concatenate(ids), np.concatenate(xs)
                yield pa.RecordBatch.from_pylist([_block(number, a[:how.block], x[:how.block], how)], schema=_INDEX)
                number, held = number + 1, held - how.block
                ids, xs = [a[how.block:]], [x[how.block:]]
    if held:
        yield pa.RecordBatch.from_pylist([_block(number, np.concatenate(ids), np.concatenate(xs), how)], schema=_INDEX)


def _query_block(table: pa.Table) -> pa.Table:
    order = table.sort_by("id")
    x, ids = matrix(order.column("vec").combine_chunks()), order.column("id").to_numpy()
    return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()], pa.int64()), "n": pa.array([len(ids)], pa.int32()),
                     "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()), "vecs": pa.array([x.astype("<f8").tobytes()], pa.binary())})


class Block:
    """The sorted arrays of one block of the index."""

    def __init__(self, row: dict, k: int, how: Collisions):
        self.how, self.n, self.top = how, row["n"].as_py(), row["top"].as_py()
        self.ids = np.frombuffer(row["ids"].as_buffer(), dtype="<i8")
        self.x = np.frombuffer(row["vecs"].as_buffer(), dtype="<f8").reshape(self.n, -1)
        vals = np.frombuffer(row["vals"].as_buffer(), dtype="<f4").reshape(how.lines, self.n)
        self.ords = np.frombuffer(row["ords"].as_buffer(), dtype="<i4").reshape(-1)
        # all lines in one sorted array: a line's values are lifted over the line's before
        self.low = float(vals.min())
        self.lift = float(vals.max()) - self.low + 1.0
        self.flat = (vals.astype(np.float64) + self.lift * np.arange(how.lines)[:, None]).reshape(-1)
        # the first window of a query without k verified: what some of the block's own vectors need for k neighbours, at least
        some = self.x[::max(1, self.n // 32)] / self.top
        near = np.partition(some @ self.x.T / self.top, max(0, self.n - k - 1), axis=1)[:, max(0, self.n - k - 1)]
        self.start = max(0.01, how.reach * math.sqrt(max(0.0, 2.0 - 2.0 * float(near.max()))))

    def collide(self, p: np.ndarray, half: float) -> np.ndarray:
        """Rows whose projections lie within ``half`` of ``p`` on enough lines."""
        line = np.arange(self.how.lines)
        edge = self.lift * line
        ends = np.concatenate([np.clip(p - half, self.low, self.low + self.lift) + edge, np.clip(p + half, self.low - 0.5, self.low + self.lift - 0.5) + edge])
        at = np.searchsorted(self.flat, ends)
        lo, hi = at[:len(line)], np.maximum(at[len(line):], at[:len(line)])
        begin, end = line * self.n, (line + 1) * self.n
        least = self.how.threshold
        if 2 * int((hi - lo).sum()) > len(self.flat):
            parts = [self.ords[a:b] for a, b in zip(begin, lo) if a < b] + [self.ords[a:b] for a, b in zip(hi, end) if a < b]
            missed = np.bincount(np.concatenate(parts), minlength=self.n) if parts else np.zeros(self.n, dtype=np.int64)
            return np.flatnonzero(missed <= self.how.lines - least)
        parts = [self.ords[a:b] for a, b in zip(lo, hi) if a < b]
        return np.flatnonzero(np.bincount(np.concatenate(parts), minlength=self.n) >= least) if parts else np.empty(0, dtype=np.int64)


class Search:
    """The k best so far of a block of queries."""

    def __init__(self, row: dict, k: int, how: Collisions):
        self.how, self.k = how, k
        n = row["n"].as_py()
        self.own = np.frombuffer(row["ids"].as_buffer(), dtype="<i8")
        self.q = np.frombuffer(row["vecs"].as_buffer(), dtype="<f8").reshape(n, -1)
        self.long = np.sqrt((self.q * self.q).sum(axis=1))
        self.p = np.hstack([self.q / self.long[:, None], np.zeros((n, 1))]) @ directions(self.q.shape[1] + 1, how)
        self.ids = [np.empty(0, dtype=np.int64) for _ in range(n)]
        self.scores = [np.empty(0) for _ in range(n)]
        self.verified = self.met = 0

    def _verify(self, i: int, block: Block, rows: np.ndarray) -> None:
        self.verified += len(rows)
        rows = rows[block.ids[rows] != self.own[i]]
        ids = np.concatenate([self.ids[i], block.ids[rows]])
        scores = np.concatenate([self.scores[i], block.x[rows] @ self.q[i]])
        if len(ids) > self.k:
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            some = np.flatnonzero(scores >= edge)
            some = some[np.lexsort((ids[some], -scores[some]))[:self.k]]
            ids, scores = ids[some], scores[some]
        self.ids[i], self.scores[i] = ids, scores

    def worst(self, i: int) -> float:
        return float(self.scores[i].min()) if len(self.scores[i]) == self.k else -math.inf

    def through(self, block: Block) -> None:
        """Verify what collides in the block; with k verified, one window that the k-th best sets."""
        most = 4.0 * self.how.reach  # twice the largest distance: everything
        for i in range(len(self.q)):
            self.met += block.n
            unit = float(self.long[i]) * block.top
            width = lambda: self.how.reach * math.sqrt(max(0.0, 2.0 - 2.0 * self.worst(i) / unit))
            if self.worst(i) > unit:
                continue  # no vector of the block reaches the k-th best
            if self.worst(i) > -math.inf:
                self._verify(i, block, block.collide(self.p[i], width()))
                continue
            half, done = block.start, np.zeros(block.n, dtype=bool)
            while True:  # until the k-th best lies within what the windows stand for
                rows = block.collide(self.p[i], half) if half < most else np.arange(block.n)
                self._verify(i, block, rows[~done[rows]])
                done[rows] = True
                if half >= most or self.worst(i) > -math.inf and half >= width():
                    break
                half *= self.how.widen

    def found(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.own, [len(x) for x in self.ids])), pa.array(np.concatenate(self.ids)),
                                           pa.array(np.concatenate(self.scores))], names=["query_id", "vec_id", "score"])


def _search(batches: Iterator[pa.RecordBatch], k: int, how: Collisions) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, chunk, block): a block of queries (block -1), then the blocks of the index that it goes through."""
    search = None
    for b in batches:
        for i in range(b.num_rows):
            row = {c: b.column(c)[i] for c in ("block", "n", "top", "ids", "vecs", "vals", "ords")}
            if row["block"].as_py() < 0:
                if search is not None:
                    yield search.found()
                search = Search(row, k, how)
            else:
                search.through(Block(row, k, how))
    if search is not None:
        yield search.found()


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, how: Collisions = Collisions(), id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """The k nearest found of every query: query_id, rank, vec_id, score."""
    data = usable(vectors, id_col, vector_col)
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    facts = data.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dims")).first()
    asked = usable(queries, id_col, vector_col).dropDuplicates(["id"])
    blocks, chunks = max(1, -(-(facts.n or 0) // how.block)), max(1, -(-asked.count() // how.queries))
    parts = -(-blocks // _GROUP)

    def query_block(table: pa.Table) -> pa.Table:
        return _query_block(table)

    ranged = data.withColumn("long", square).repartitionByRange(blocks, F.desc("long"), "id").sortWithinPartitions(F.desc("long"), "id")
    built = stored(ranged.select("id", "vec").mapInArrow(partial(_index, how=how), _INDEX_SQL), "ann-index")
    asked = stored(asked.where(F.size("vec") == (facts.dims or 0)).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)))
                   .groupBy("chunk").applyInArrow(query_block, "chunk bigint, n int, ids binary, vecs binary"), "ann-queries")
    # every block of queries goes through every part of the index
    number = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = built.withColumn("part", F.shiftright("block", 20) % parts).withColumn("chunk", number(chunks))
    right = asked.withColumn("part", number(parts)).withColumn("block", F.lit(-1).cast("bigint"))
    met = right.unionByName(left, allowMissingColumns=True).select("part", "chunk", "block", "n", "top", "ids", "vecs", "vals", "ords")
    # a chunk without queries (no id has its hash) has blocks only
    met = met.join(F.broadcast(asked.select("chunk")), "chunk", "left_semi") if chunks <= 100_000 else met.join(asked.select("chunk"), "chunk", "left_semi")
    found = (met.repartition("part", "chunk").sortWithinPartitions("part", "chunk", "block")
             .mapInArrow(partial(_search, k=k, how=how), "query_id bigint, vec_id bigint, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
