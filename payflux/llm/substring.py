"""Operator 8: substring deduplication by difference-cover anchors.

A window is ``window`` consecutive words of a document. Windows that occur twice
are found without hashing every position of every text for the shuffle: short
anchors are hashed only where the position modulo a period lies in a difference
cover. For any two positions some shift below the period takes both into the
cover, so two equal windows share an anchor at the same shift. Anchors that
repeat mark the windows around them; those are extended to the full window,
hashed with 96 bits and counted.

Both counts work alike: a task marks what repeats within its own batch by
itself and sends one row per distinct hash, so a passage that a third of all
documents hold costs a row per batch, not one per occurrence.

Defined results: a null text has no words; texts shorter than a window lose
nothing; repeated rows are occurrences of their own, so their windows repeat;
rows are returned as often as they stand in the input; all occurrences of a window
count alike, so there are no ties; texts of any length are taken whole, a longer one in
a batch of its own; extra columns are not read, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.llm.common import doc_words, inverse, mix, powers, slices, stored, text_bytes, word_bounds

# Perfect difference sets by period; every difference modulo the period occurs once.
COVERS = {
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    21: (0, 1, 6, 8, 18),
    31: (1, 5, 11, 24, 25, 27),
}


def cover_for(window: int, least: int = 12) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor length: the largest period that leaves anchors of ``least`` words.

    A window too short for that has period 1: every position is covered.
    """
    fits = [m for m in COVERS if window - m + 1 >= least]
    return (max(fits), COVERS[max(fits)], window - max(fits) + 1) if fits else (1, (0,), window)


def run_hashes(words: np.ndarray, first: np.ndarray, width: int, seeds: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row, position in the row and hashes of every run of ``width`` words within a row, by prefix sums over all rows."""
    n = len(words) - width + 1
    if n <= 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, [np.empty(0, dtype=np.uint64) for _ in seeds]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    good = np.flatnonzero(row[:n] == row[width - 1:])
    out = []
    for seed in seeds:
        base = (0xD6E8FEB86659FD93 + 0x1B873593 * 2 * seed) | 1
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(mix(words + np.uint64(seed)) * powers(base, len(words)), dtype=np.uint64, out=sums[1:])
        out.append(mix((sums[good + width] - sums[good]) * powers(inverse(base), n)[good]))
    return row[good], good - first[row[good]], out


#: Of a row sent for counting: alone in its batch, one for several in its batch, found to repeat in its batch.
ALONE, SEVERAL, FOUND = 0, 1, 2
SENT = "h1 bigint, h2 int, id bigint, th bigint, pos int, kind tinyint"


def _sent(h1: np.ndarray, h2: np.ndarray, ids: np.ndarray, th: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """What a batch sends: a row per distinct hash, and its own positions that repeat within the batch.

    Of the second hash the upper half travels; it tells apart what the first one does not.
    """
    order = np.lexsort((h2, h1))
    h1, h2, ids, th, pos = h1[order], h2[order], ids[order], th[order], pos[order]
    new = np.ones(len(h1), dtype=bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    size = np.diff(np.append(np.flatnonzero(new), len(new)))
    several = np.repeat(size > 1, size)
    lone = ~several
    heads = new & several
    spread = mix(h1 + pos.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids.astype(np.uint64))  # found rows go anywhere

    def put(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.concatenate([a, b, c])

    zero = np.zeros(int(heads.sum()), dtype=np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(put(h1[lone], h1[heads], spread[several]).view(np.int64)),
        pa.array((put(h2[lone], h2[heads], h2[several] & np.uint64(0)) >> np.uint64(32)).astype(np.uint32).view(np.int32)),
        pa.array(put(ids[lone], zero, ids[several])), pa.array(put(th[lone], zero, th[several])),
        pa.array(put(pos[lone], zero, pos[several]).astype(np.int32)),
        pa.array(np.repeat(np.array([ALONE, SEVERAL, FOUND], dtype=np.int8), [int(lone.sum()), int(heads.sum()), int(several.sum())])),
    ], names=["h1", "h2", "id", "th", "pos", "kind"])


def _counted(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    if parts and any(len(p[0]) for p in parts):
        yield _sent(*(np.concatenate(x) for x in zip(*parts)))


def _by_batch(batches: Iterator[pa.RecordBatch], of: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from _counted([of(b) for b in slices(whole, "text")])


def _anchors(batch: pa.RecordBatch, period: int, cover: tuple[int, ...], length: int) -> tuple[np.ndarray, ...]:
    words, first = doc_words(batch.column("text"))
    row, pos, (h,) = run_hashes(words, first, length, (1,))
    at = np.isin(pos % period, cover)
    row, pos, h = row[at], pos[at], h[at]
    ids, th = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "th"))
    return h, np.zeros(len(h), dtype=np.uint64), ids[row], th[row], pos


def _windows(batch: pa.RecordBatch, period: int, window: int) -> tuple[np.ndarray, ...]:
    """Hashes of the windows that start at most ``period`` - 1 words before an anchor that repeats."""
    words, first = doc_words(batch.column("text"))
    row, pos, (h1, h2) = run_hashes(words, first, window, (2, 3))
    marks = batch.column("marks")
    lists = np.diff(marks.offsets.to_numpy())
    base = first[:-1]
    at = np.repeat(base, lists) + marks.flatten().to_numpy(zero_copy_only=False)
    low = np.repeat(base, lists)
    delta = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(delta, np.maximum(at - period + 1, low), 1)
    np.add.at(delta, at + 1, -1)
    near = np.cumsum(delta)[:-1] > 0
    hit = near[first[row] + pos] if len(row) else np.empty(0, dtype=bool)
    row, pos = row[hit], pos[hit]
    ids, th = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "th"))
    return h1[hit], h2[hit], ids[row], th[row], pos


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by hash: places found before, and places alone in their batch whose hash came from elsewhere too.

    Between batches only one row and whether its hash has repeated are kept.
    """
    held: tuple | None = None  # (h1, h2, row or None once it has repeated)
    names = ["id", "th", "pos"]
    empty = {c: np.empty(0, dtype=np.int64) for c in names}
    for batch in batches:
        c = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
        kind = c["kind"]
        out = [{n: c[n][kind == FOUND] for n in names}]
        c = {n: v[kind != FOUND] for n, v in c.items()}
        h1, h2, alone = c["h1"], c["h2"], c["kind"] == ALONE
        if len(h1):
            new = np.ones(len(h1), dtype=bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            starts = np.flatnonzero(new)
            size = np.diff(np.append(starts, len(new)))
            twice = (size > 1) | np.logical_or.reduceat(~alone, starts)
            if held is not None and held[0] == h1[0] and held[1] == h2[0]:
                twice[0] = True
                if held[2] is not None:
                    out.append({n: np.array([v]) for n, v in zip(names, held[2])})
            hit = np.repeat(twice, size) & alone
            out.append({n: c[n][hit] for n in names})
            last = None if twice[-1] else tuple(c[n][-1] for n in names)
            held = (h1[-1], h2[-1], last)
        got = {n: np.concatenate([empty[n], *[o[n] for o in out]]) for n in names}
        if len(got["id"]):
            yield pa.RecordBatch.from_arrays([pa.array(got["id"].astype(np.int64)), pa.array(got["th"].astype(np.int64)),
                                              pa.array(got["pos"].astype(np.int32))], names=names)


def _places(sent: DataFrame) -> DataFrame:
    """Per document the positions whose hash repeats anywhere."""
    return (sent.repartition("h1").sortWithinPartitions("h1", "h2").mapInArrow(_repeated, "id bigint, th bigint, pos int")
            .groupBy("id", "th").agg(F.collect_set("pos").alias("marks")))


def _removed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            raw, off = text_bytes(batch.column("text"))
            starts, stops, first = word_bounds(raw, off)
            lists = np.diff(batch.column("marks").offsets.to_numpy())
            at = np.repeat(first[:-1], lists) + batch.column("marks").flatten().to_numpy(zero_copy_only=False)
            delta = np.zeros(len(starts) + 1, dtype=np.int64)
            np.add.at(delta, at, 1)
            np.add.at(delta, at + window, -1)
            gone = np.cumsum(delta)[:-1] > 0
            data = raw.tobytes()
            kept = []
            for i in range(batch.num_rows):
                a, b = first[i], first[i + 1]
                if lists[i]:
                    stay = a + np.flatnonzero(~gone[a:b])
                    kept.append(b" ".join([data[s:e] for s, e in zip(starts[stay].tolist(), stops[stay].tolist())]))
                else:
                    kept.append(b" ".join(data[off[i]:off[i + 1]].split()))
            cut = np.concatenate([[0], np.cumsum(gone)])
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in batch.schema.names if c not in ("text", "marks")],
                pa.array(np.diff(first).astype(np.int64)), pa.array((cut[first[1:]] - cut[first[:-1]]).astype(np.int64)),
                pa.array([k.decode() for k in kept], pa.string()),
            ], names=[*[c for c in batch.schema.names if c not in ("text", "marks")], "n_words", "n_removed", "kept"])


def _digests(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b in _removed(batches, window):
        sha = [hashlib.sha256(t.as_py().encode()).hexdigest() for t in b.column("kept")]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_words"), b.column("n_removed"), pa.array(sha, pa.string())],
                                         names=["id", "n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Per document: id, n_words, n_removed and ``kept`` (the kept words joined by a space) or its digest ``kept_sha256``.

    A document is known by its id; where the id is null or repeats, by a 64-bit hash
    of its text besides (0 for the others, which compresses away). The positions
    of each step are stored, so the shuffle of one step is gone before the next.
    """
    period, cover, length = cover_for(window)
    key = F.col(id_col).cast("bigint")
    again = stored(docs.where(key.isNotNull()).groupBy(key.alias("_again_")).agg(F.count("*").alias("n")).where("n > 1").select("_again_"), "repeated-ids")
    rows = docs.select(id_col, text_col).join(again, key == F.col("_again_"), "left").select(
        F.coalesce(key, F.lit(-(1 << 63))).alias("id"),
        F.when(key.isNull() | F.col("_again_").isNotNull(), F.xxhash64(text_col, key.isNull())).otherwise(F.lit(0).cast("bigint")).alias("th"),
        F.coalesce(text_col, F.lit("")).alias("text"))
    sent = rows.mapInArrow(
        partial(_by_batch, of=partial(_anchors, period=period, cover=cover, length=length)), SENT)
    near = rows.join(stored(_places(sent), "anchors"), ["id", "th"])
    sent = near.mapInArrow(partial(_by_batch, of=partial(_windows, period=period, window=window)), SENT)
    marked = (rows.join(stored(_places(sent), "windows"), ["id", "th"], "left")
              .withColumn("marks", F.coalesce("marks", F.array().cast("array<int>"))))
    if digest:
        out = marked.select("id", "text", "marks").mapInArrow(
            partial(_digests, window=window), "id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    else:
        out = marked.select("id", "text", "marks").mapInArrow(
            partial(_removed, window=window), "id bigint, n_words bigint, n_removed bigint, kept string")
    return out.withColumn("id", F.nullif("id", F.lit(-(1 << 63)))).withColumnRenamed("id", id_col)
