"""Operator 9: toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are single words, pairs of neighbours and pairs with one word between
them (A to Z in lower case, ASCII punctuation as white space), hashed to a table
of fixed size; each counts once per document. Training is one pass after
another over a bounded sample of labelled rows, in one task that streams them;
per-coordinate rates and the L1 bound leave few weights, which every task gets.

Defined results: a null or empty text has the bias alone as its feature, so its
score is that of an unknown text; repeated rows score alike; labels that are
null are not learnt from; without any label every score is 0.5 or less (no weight).
Of ids with equal hashes the smaller is sampled first; an id with several labels counts
as toxic if one of them says so, and is learnt from once. Long texts are read whole, a
few megabytes at a time with others, or alone. ``clean`` keeps the input's columns,
whatever their names; training and scoring read the id and text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.llm.common import mix, slices, text_bytes, lower_ascii, word_bounds, word_hashes

#: Bytes read as white space besides ASCII white space: ASCII punctuation.
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


@dataclass(frozen=True)
class Settings:
    """``rows`` bounds the labelled sample; a feature needs ``seen`` rows of it to be learnt;
    the rest are the rates and bounds of FTRL-proximal."""

    bits: int = 20
    rows: int = 20_000
    seen: int = 5
    passes: int = 5
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 0.0
    threshold: float = 0.7


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Table indices of all features of all rows, and the row of each. Index 0 is the bias."""
    raw, off = text_bytes(column)
    raw = lower_ascii(raw)
    raw = np.where(_PUNCT[raw], np.uint8(32), raw)
    starts, stops, first = word_bounds(raw, off)
    words = word_hashes(raw, starts, stops)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    parts, rows = [words], [row]
    for gap, factor in ((1, np.uint64(0x9FB21C651E98DF25)), (2, np.uint64(0xD1342543DE82EF95))):
        if len(words) > gap:
            same = row[gap:] == row[:-gap]
            parts.append(mix(words[:-gap] * factor + words[gap:])[same])
            rows.append(row[gap:][same])
    index = (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int32)
    index[index == 0] = 1
    return index, np.concatenate(rows)


def _training_rows(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            index, row = features(batch.column("text"), bits)
            order = np.argsort(row, kind="stable")
            index, cut = index[order], np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            blobs = [np.unique(index[a:b]).astype("<i4").tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("doc_id"), batch.column("toxic"),
                                              pa.array(blobs, pa.binary())], names=["h", "doc_id", "toxic", "idx"])


def ftrl(examples: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """One pass of FTRL-proximal over the examples, in place on the coordinate sums ``z`` and ``n``."""
    for idx, y in examples:
        zi, ni = z[idx], n[idx]
        root = np.sqrt(ni)
        w = -(zi - np.sign(zi) * s.l1) / ((s.beta + root) / s.alpha + s.l2)
        w[np.abs(zi) <= s.l1] = 0.0
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n[idx] = ni + g * g
        z[idx] = zi + g - (np.sqrt(ni + g * g) - root) / s.alpha * w


def weights_of(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    w = -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
    return np.where(np.abs(z) <= s.l1, 0.0, w)


def _train(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    kept = []  # the sample, bounded by s.rows
    for b in batches:
        kept += [(np.frombuffer(i, dtype="<i4"), int(y)) for i, y in zip(b.column("idx").to_pylist(), b.column("toxic").to_pylist())]
    seen = np.zeros(1 << s.bits, dtype=np.int32)
    for idx, _ in kept:
        seen[idx] += 1  # no index twice in a row
    often = seen >= s.seen
    bias = np.zeros(1, dtype=np.int32)
    for k, (idx, y) in enumerate(kept):  # in place: the whole sample is held once
        kept[k] = (np.concatenate([bias, idx[often[idx]]]), y)
    for _ in range(s.passes):
        ftrl(kept, z, n, s)
    w = weights_of(z, n, s)
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w[at], pa.float64())], names=["i", "w"])


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), learn: str = "pmod(crc32(cast(doc_id as string)), 3) <> 1",
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """Non-zero weights (index, weight) learnt from at most ``s.rows`` labelled rows, those of smallest id hash.

    Of an id that stands in several rows one text is learnt from, that of the smallest hash.

    The sample's ids are bounded by ``s.rows``, so they are broadcast; the weights
    are bounded by the table of ``2 ** s.bits``.
    """
    marked = (labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
              .where("doc_id is not null and toxic is not null").where(learn)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(s.rows))
    rows = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(marked), "doc_id")
            .groupBy("h", "doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("t"), "text")).alias("one"))
            .select("h", "doc_id", "toxic", "one.text"))
    fit = (rows.mapInArrow(partial(_training_rows, bits=s.bits), "h bigint, doc_id bigint, toxic int, idx binary")
           .repartition(1).sortWithinPartitions("h", "doc_id", "idx")
           .mapInArrow(partial(_train, s=s), "i int, w double").toPandas())
    return fit["i"].to_numpy(), fit["w"].to_numpy()


def _score(batches: Iterator[pa.RecordBatch], at: np.ndarray, w: np.ndarray, bits: int,
           keep_text: bool) -> Iterator[pa.RecordBatch]:
    table = np.zeros(1 << bits)
    table[at] = w
    for batch in batches:
        out = np.empty(batch.num_rows)
        done = 0
        for part in slices(batch, "text"):
            index, row = features(part.column("text"), bits)
            hit = table[index] != 0.0
            pair = np.unique((row[hit].astype(np.int64) << 32) | index[hit])
            total = np.bincount(pair >> 32, weights=table[pair & 0xFFFFFFFF], minlength=part.num_rows) + table[0]
            out[done:done + part.num_rows] = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
            done += part.num_rows
        cols = [c for c in batch.schema.names if keep_text or c != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in cols], pa.array(out)], names=[*cols, "score"])


def score(docs: DataFrame, fit: tuple[np.ndarray, np.ndarray], s: Settings = Settings(), id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Id and score of every text."""
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        partial(_score, at=fit[0], w=fit[1], bits=s.bits, keep_text=False), "id bigint, score double").withColumnRenamed("id", id_col)


def clean(docs: DataFrame, fit: tuple[np.ndarray, np.ndarray], s: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; all columns pass as they are."""
    others = [c for c in docs.columns if c != text_col]
    inner = docs.select(F.struct(*others).alias("row") if others else F.lit(0).alias("row"), F.col(text_col).alias("text"))
    kind = inner.schema["row"].dataType.simpleString()
    out = inner.mapInArrow(partial(_score, at=fit[0], w=fit[1], bits=s.bits, keep_text=True),
                           f"row {kind}, text string, score double").where(F.col("score") < s.threshold)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])


def toxicity(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    out = score(docs, train(docs, labels, s), s)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= s.threshold).cast("int").alias("predicted"))
