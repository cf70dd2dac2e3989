"""Commit bookkeeping of the append-only store across commit ranges."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

from payflux.streaming.store import TableStore

ROWS = StructType([StructField("id", LongType())])


def test_commits_across_ranges_and_jobs(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "s"), job="a", range_size=3)
    assert st.last_commit() is None
    for b in [0, 1, 2, 3, 4, 7, 8, 11]:  # gaps, several ranges
        assert st.commit(b, {"t": spark.range(b, b + 1)})
    assert st.last_commit() == 11
    assert not st.commit(11, {"t": spark.range(1)}) and not st.commit(5, {})  # replays refused
    st.for_job("b").commit(0, {"t": spark.range(100, 102)})
    log = {r["job"]: r["upto"] for r in st.commit_log().collect()}
    assert log == {"a": 11, "b": 0}
    assert st.appended("t", ROWS).count() == 8 + 2
    # another store object (another process) sees the same state
    assert TableStore(spark, str(tmp_path / "s"), job="a", range_size=3).last_commit() == 11
    # a commit many ranges further is found
    assert st.commit(40, {"t": spark.range(1)})
    st2 = TableStore(spark, str(tmp_path / "s"), job="a", range_size=3)
    assert st2.last_commit() == 40 and st2.is_committed(39) and not st2.is_committed(41)


def test_ttl_state_compaction_keeps_results(spark, tmp_path):
    """TTL dedup over two micro-batches with a compaction (dropping expired
    keys) in between gives the batch operator's result."""
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from payflux.operators.dedup import dedup_ttl
    from payflux.sources import fixtures as fx
    from payflux.streaming import ttl

    rows = fx.payment_retries(spark, SF_SMALL).select("_txnID", "attempt", "timestamp")
    mid = rows.agg(F.expr("percentile_approx(timestamp, 0.5)")).first()[0]
    first, second = rows.filter(F.col("timestamp") < mid), rows.filter(F.col("timestamp") >= mid)
    st = TableStore(spark, str(tmp_path / "s"), job="ttl")
    ttl.ensure_ttl_state(st, rows, "_txnID")
    run = ttl.ttl_dedup_batch(st, "_txnID", "timestamp", "attempt", 5000, str(tmp_path / "kept"))
    run(first, 0)
    # keys last kept before mid - ttl can no longer suppress anything of the second batch
    assert ttl.compact_ttl_state(st, rows, "_txnID", mid - 5000) == 1
    run(second, 1)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "kept"))
                 .select("_txnID", "attempt", "timestamp").collect())
    want = sorted(tuple(r) for r in dedup_ttl(rows).select("_txnID", "attempt", "timestamp").collect())
    assert got == want


def test_range_registered_without_record_falls_back(spark, tmp_path):
    """A commit that registered a new range but died before its record: the
    last commit is still found in the range below."""
    st = TableStore(spark, str(tmp_path / "s"), job="a", range_size=3)
    st.commit(1, {"t": spark.range(1)})
    st.commit(10, {"t": spark.range(1)})  # ranges 1 and 2 skipped
    spark.range(1).selectExpr("current_timestamp() AS committed_at").write.parquet(
        st._path("_jobs", "job=a", "range=7"))  # registered, record never written
    assert st.last_commit() == 10
    assert not st.commit(10, {"t": spark.range(1)})


def test_state_reads_only_uncovered_committed_batches(spark, tmp_path):
    """State = base + committed deltas, read by globbing exactly the uncovered
    committed batches of the jobs that write the delta table."""
    from pyspark.sql import functions as F

    schema = StructType([StructField("k", LongType()), StructField("d", LongType())])

    def fold(base, deltas):
        return base.unionByName(deltas).groupBy("k").agg(F.sum("d").alias("d"))

    st = TableStore(spark, str(tmp_path / "s"), range_size=2)
    st.seed({"acc": spark.createDataFrame([(1, 100), (2, 100)], schema)})
    a, b = st.for_job("a"), st.for_job("b")
    a.commit(0, {"deltas": spark.createDataFrame([(1, -5)], schema)})
    b.commit(0, {"other": spark.range(1)})                    # b never writes deltas
    a.commit(3, {"deltas": spark.createDataFrame([(2, 7)], schema)})
    b.commit(1, {"other": spark.range(1), "deltas": spark.createDataFrame([(1, 1)], schema)})  # new table mid-range
    # an uncommitted batch folder is never read
    spark.createDataFrame([(1, 1000)], schema).write.parquet(st._path("deltas", "job=a", "batch=9"))
    got = {r["k"]: r["d"] for r in st.state("acc", "deltas", schema, fold).collect()}
    assert got == {1: 96, 2: 107}
    full = StructType(schema.fields + [StructField("job", StringType()), StructField("batch", LongType())])
    assert st._bounded("deltas", full, spark.createDataFrame([], "job string, upto long"),
                       st.commit_log()) is not None  # planned as a glob read, no fallback
    assert st.compact("acc", "deltas", schema, fold) == 1
    a.commit(4, {"deltas": spark.createDataFrame([(2, -7)], schema)})
    got = {r["k"]: r["d"] for r in st.state("acc", "deltas", schema, fold).collect()}
    assert got == {1: 96, 2: 100}


def test_truncate_hides_what_was_committed_before(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "s"), job="a", range_size=3)
    st.truncate("t")  # nothing written yet
    for b in range(5):
        st.commit(b, {"t": spark.range(b, b + 1)})
    st.truncate("t")
    assert st.appended("t", ROWS).count() == 0
    st.for_job("b").commit(0, {"t": spark.range(100, 102)})
    st.commit(5, {"t": spark.range(5, 6)})
    assert sorted(r["id"] for r in st.appended("t", ROWS).collect()) == [5, 100, 101]


def test_rows_of_a_batch_need_its_own_record(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "s"), job="a")
    spark.range(3).write.parquet(f"{st.base}/t/job=a/batch=0")  # failed before its record
    st.commit(1, {"t": spark.range(10, 11)})
    assert st.batch_rows("t", 0) is None and st.batch_rows("u", 1) is None
    assert [r["id"] for r in st.batch_rows("t", 1).collect()] == [10]
    st.discard(0)
    assert [r["id"] for r in st.appended("t", ROWS).collect()] == [10]
