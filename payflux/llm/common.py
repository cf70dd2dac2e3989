"""Helpers shared by the corpus operators: tables, scratch tables, word hashes, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payflux.session import ensure_checkpoint_dir

#: ASCII white space: the words of every operator here are maximal runs of other bytes.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD = r"[^\x20\x09-\x0D]+"

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_CHUNK = 1 << 20  # bytes hashed at a time


def shipped(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, once per Spark application, by Spark's own file distribution."""
    sc = spark.sparkContext
    name = "payflux-code.zip"
    if not any(os.path.basename(f) == name for f in sc.listFiles):
        top = Path(__file__).resolve().parent.parent
        out = os.path.join(tempfile.mkdtemp(prefix="payflux-code-"), name)  # read by the driver alone, which serves it
        with zipfile.ZipFile(out, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        sc.addPyFile(out)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Paths of the tables that ``stored`` has written, oldest first, for ``drop_stored``.
WRITTEN: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage without losing rows when an executor dies, in a columnar,
    compressed form (``checkpoint()`` keeps plain rows). The shuffle files of the
    job that wrote it are deleted at its end: nothing reads them any more.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_parts(frames: list[DataFrame], name: str) -> DataFrame:
    """The union of frames of one schema, written like ``stored`` one after the other into one table."""
    spark = frames[0].sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        for df in frames:
            df.write.mode("append").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    WRITTEN.append(path)
    return spark.read.schema(frames[0].schema).parquet(path)


def drop_stored(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of ``stored`` that no frame in use reads any more."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(conf).delete(at, True)
        if p in WRITTEN:
            WRITTEN.remove(p)


def inverse(x: int) -> int:
    """Inverse of an odd number modulo 2**64."""
    return pow(x, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (two multiply and shift rounds)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class _Powers:
    """Powers of the byte base and of its inverse, grown as needed, kept by a worker."""

    up = np.empty(0, dtype=np.uint64)
    down = np.empty(0, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up = powers(int(_BASE), n)
            cls.down = powers(inverse(int(_BASE)), n)
        return cls.up, cls.down


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the row offsets in them; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A to Z in lower case; all other bytes as they are."""
    return raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)


def word_bounds(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the index of its first word (plus the total)."""
    word = ~SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[off] = True
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends[:-1] &= ~word[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, off)


def word_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: polynomial in its bytes by prefix sums, then mixed with its length."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + _CHUNK, side="right")))
        lo, hi = int(starts[i]), int(stops[j - 1])
        up, down = _Powers.get(max(hi - lo + 1, _CHUNK))
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((raw[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], dtype=np.uint64, out=sums[1:])
        s, e = starts[i:j] - lo, stops[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
        i = j
    return mix(out)


def doc_words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows in a line, and where each row's words begin (plus the total)."""
    raw, off = text_bytes(column)
    if lower:
        raw = lower_ascii(raw)
    starts, stops, first = word_bounds(raw, off)
    return word_hashes(raw, starts, stops), first


def window_hashes(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every run of ``width`` words of one line of words, by prefix sums."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base = (0xD6E8FEB86659FD93 + 2 * seed) | 1
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(base, len(words)), dtype=np.uint64, out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(inverse(base), n))


def slices(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows of about ``most`` bytes of text; a longer row stands alone."""
    if not batch.num_rows:
        return
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        before = size[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(size, before + most, side="right")))
        yield batch.slice(i, j - i)
        i = j


def connected_components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``(a, b)`` of bigints: ``(id, component)``, component = smallest id.

    Alternating large-star and small-star rounds of aggregates and joins; the
    number of rounds is logarithmic in the longest path. Every round is cut by
    a stored table, which goes, as do its shuffle files, once the next one stands.
    A hub's smallest neighbour is pre-aggregated, and its rows are joined as a
    skewed key that adaptive execution splits. Ids without links (and links of a
    null id) do not appear.
    """
    # canonical form: u > v
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    while True:
        # stars: a larger end has one link, and none is a smaller end besides
        ends = e.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            e.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        open_ = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0")
        if not open_.agg(F.count("*").alias("n")).first().n:
            break
        last = WRITTEN[-1:]
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small, "components")
        drop_stored(e.sparkSession, last)
    return e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
