"""Per-key ordered folds without collecting an unbounded group into one task.

Two folds of the reference are inherently sequential per key:

* admission: a payment is admitted iff the bank's free funds left by the
  payments admitted *before it* cover its amount (a rejected one consumes
  nothing, so a plain prefix sum is wrong);
* TTL dedup: a row is kept iff the last *kept* row of its key is at least
  TTL older.

Both are solved the same way. Keys with at most ``group_rows`` pending rows are
folded in one task by a JVM higher-order ``aggregate`` over the sorted group
(bounded memory). Larger (hot) keys are never collected: they are resolved in
exact rounds built from partial aggregations and windows partitioned by
``(key, range segment)``: the rows are range partitioned on ``(key, order)``,
whose sampled bounds cut even one hot instant of one key into evenly sized
segments, so a key holding a third of all rows is spread over many tasks.
Rounds repeat until every hot key has shrunk below the fold bound; lineage is
cut with a reliable checkpoint between rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from payflux.session import cut_lineage

MONEY = DecimalType(38, 6)
AMOUNT = DecimalType(24, 6)


# hot-key sets up to this many keys are broadcast (checked by a bounded count)
HOT_KEYS_BROADCAST_ROWS = 1_000_000


def split_hot_keys(df: DataFrame, key: str, group_rows: int,
                   max_broadcast: int = HOT_KEYS_BROADCAST_ROWS,
                   with_keys: bool = False):
    """``(small, large)``: rows of keys with at most / more than ``group_rows`` rows.

    Group sizes are a partial aggregate (a hot key costs one row per map task,
    never a task of its own). The hot-key set has at most ``rows / group_rows``
    keys; it is broadcast only when a bounded count proves it has at most
    ``max_broadcast`` keys, else the semi/anti joins shuffle. Rows are never
    joined to a per-key size, so no task receives a hot key's rows here.
    ``large`` is None when no key is hot. A NULL key is a key like any other.
    With ``with_keys`` also returns the hot-key frame (column ``_hot_key``) and
    whether it is proven small enough to broadcast.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_grp_n"))
    hot_keys = sizes.filter(F.col("_grp_n") > group_rows).select(F.col(key).alias("_hot_key"))
    n_hot = hot_keys.limit(max_broadcast + 1).count()
    if n_hot == 0:  # the usual case: nothing to materialise
        return (df, None, None, False) if with_keys else (df, None)
    # materialised once (reliable checkpoint, no cache to leak across micro-batches)
    hot = cut_lineage(hot_keys)
    bounded = n_hot <= max_broadcast
    side = F.broadcast(hot) if bounded else hot
    cond = F.col(key).eqNullSafe(F.col("_hot_key"))
    small, large = df.join(side, cond, "left_anti"), df.join(side, cond, "left_semi")
    return (small, large, hot, bounded) if with_keys else (small, large)


def _per_hot_key(df: DataFrame, bounded: bool) -> DataFrame:
    """A frame with at most one row per hot key: broadcast when the hot-key
    count was proven small, so joining it to a hot key's rows needs no shuffle
    of those rows by key."""
    return F.broadcast(df) if bounded else df


def _before(ts: str, tie: str, k: Column) -> Column:
    return (F.col(ts) < k[ts]) | ((F.col(ts) == k[ts]) & (F.col(tie) < k[tie]))


def _same(ts: str, tie: str, k: Column) -> Column:
    return (F.col(ts) == k[ts]) & (F.col(tie) == k[tie])


# --------------------------------------------------------------------------- admission

def ordered_admission(candidates: DataFrame, funds: DataFrame, key: str = "source_bank",
                      ts: str = "timestamp", tie: str = "_txnID", amount: str = "amount",
                      group_rows: int = 4096, segments: int | None = None) -> DataFrame:
    """Admit ``amount`` rows per ``key`` in ``(ts, tie)`` order against
    ``funds(key, free)``; returns the candidate columns plus ``admitted``.
    A negative or NULL amount is never admitted, whatever the size of its key.

    Money is exact: amounts and funds are DECIMAL(38,6) inside the fold, so the
    fold and the distributed prefix rounds take identical decisions.
    Candidates whose key has no funds row are not admitted.

    Two passes: a key whose requests together fit its funds admits all of them
    whatever their order (``split_contended``); only the rows of the other keys
    are folded.
    """
    cols = candidates.columns
    pending = candidates.withColumn("_amt", F.col(amount).cast(AMOUNT))
    free = funds.select(F.col(key), F.col("free").cast(MONEY).alias("_free"))
    plain, pending = split_contended(pending, free, key)
    decided: list[DataFrame] = [plain.select(*cols, F.coalesce(F.col("_amt") >= 0, F.lit(False)).alias("admitted"))]
    if pending is None:
        return decided[0]
    round_no = 0
    while True:
        small, large, hot, bounded = split_hot_keys(pending, key, group_rows, with_keys=True)
        decided.append(_fold_admission(small, free, key, ts, tie, cols))
        if large is None:
            break
        # funds of the hot keys only (one row per key): at most as many rows as hot keys
        hot_free = free.join(hot, F.col(key).eqNullSafe(F.col("_hot_key")), "left_semi")
        done, pending, free = _prefix_round(large, hot_free, key, ts, tie, cols, segments, bounded)
        decided.append(done)
        pending, free = cut_lineage(pending), cut_lineage(free)
        round_no += 1
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out


def split_contended(pending: DataFrame, free: DataFrame, key: str,
                    max_broadcast: int = HOT_KEYS_BROADCAST_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """``(plain, contended)``: rows of keys whose requested amounts (negative and NULL
    ones ask for nothing) add up to at most the key's free funds, and the other rows.

    The sums are a partial aggregate, one row per key, joined to the funds. The
    contended keys are materialised once and broadcast only where a bounded count
    proves them few. A key without funds is contended; ``contended`` is None
    when no key is.
    """
    asked = pending.groupBy(F.col(key).alias("_ck")).agg(
        F.coalesce(F.sum(F.when(F.col("_amt") >= 0, F.col("_amt"))), F.lit(0)).cast(MONEY).alias("_asked"))
    keys = (asked.join(free, F.col("_ck") == F.col(key), "left")
            .filter(F.col("_free").isNull() | (F.col("_asked") > F.col("_free"))).select("_ck"))
    keys = cut_lineage(keys)
    n = keys.limit(max_broadcast + 1).count()
    if n == 0:
        return pending, None
    side = F.broadcast(keys) if n <= max_broadcast else keys
    cond = F.col(key).eqNullSafe(F.col("_ck"))
    return pending.join(side, cond, "left_anti"), pending.join(side, cond, "left_semi")


def _fold_admission(rows: DataFrame, free: DataFrame, key: str, ts: str, tie: str,
                    cols: list[str]) -> DataFrame:
    item = F.struct(F.col(ts).alias("_o1"), F.col(tie).alias("_o2"), F.col("_amt"),
                    F.struct(*[F.col(c) for c in cols]).alias("_row"))
    groups = rows.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    g = groups.join(free, key, "left")
    init = F.struct(F.col("_free").alias("r"), F.array().cast("array<boolean>").alias("ok"))

    def step(acc, x):
        fits = (x["_amt"] >= 0) & (x["_amt"] <= acc["r"])
        return F.struct(
            F.when(fits, (acc["r"] - x["_amt"]).cast(MONEY)).otherwise(acc["r"]).alias("r"),
            F.array_append(acc["ok"], F.coalesce(fits, F.lit(False))).alias("ok"))

    g = g.withColumn("_ok", F.aggregate("_items", init, step)["ok"])
    z = g.select(F.explode(F.arrays_zip(F.col("_items"), F.col("_ok"))).alias("_z"))
    return z.select(*[F.col("_z._items._row")[c].alias(c) for c in cols],
                    F.col("_z._ok").alias("admitted"))


def _segments(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_segments(df: DataFrame, key: str, order: list, segments: int | None = None) -> DataFrame:
    """Tag rows with ``_seg``: the range partition of ``(key, *order)``.

    Consecutive rows of one key (in ``order``) share a segment; a hot key
    spans many segments of balanced size. The tagged rows are checkpointed
    (reliably, to the shared checkpoint dir) so every consumer sees the same
    segments, whatever the input order.
    """
    n = _segments(df, segments)
    ranged = df.repartitionByRange(n, F.col(key), *order).withColumn("_seg", F.spark_partition_id())
    return cut_lineage(ranged)


def segmented_prefix_sum(df: DataFrame, key: str, ts: str, tie: str, val: str,
                         out: str = "_s", segments: int | None = None) -> DataFrame:
    """Inclusive running sum of ``val`` per ``key`` in ``(ts, tie)`` order.

    Two levels so a hot key is split: segment totals per ``(key, segment)``
    (a small table: one row per key and segment) give each segment's offset;
    the running sum inside a segment is a window partitioned by
    ``(key, segment)``, never bigger than one range partition.
    """
    seg = range_segments(df, key, [F.col(ts), F.col(tie)], segments)
    totals = seg.groupBy(key, "_seg").agg(F.sum(val).alias("_bsum"))
    w_off = Window.partitionBy(key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_seg", F.coalesce(F.sum("_bsum").over(w_off),
                                                    F.lit(0).cast(MONEY)).alias("_off"))
    w_run = Window.partitionBy(key, "_seg").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    offsets = offsets.select(F.col(key).alias("_ok"), F.col("_seg").alias("_oseg"), "_off")
    j = (seg.join(offsets, F.col(key).eqNullSafe(F.col("_ok")) & (F.col("_seg") == F.col("_oseg")))
         .drop("_ok", "_oseg"))
    return j.withColumn(out, (F.col("_off") + F.sum(val).over(w_run)).cast(MONEY)).drop("_off", "_seg")


def _prefix_round(large: DataFrame, free: DataFrame, key: str, ts: str, tie: str,
                  cols: list[str], segments: int | None, bounded: bool = False):
    """One exact round for hot keys; it at least halves a key's free funds F.

    Rows over F (or without amount or funds) are never admitted, as F only
    shrinks. Of the others a row is small (at most F / 2) or big. Only the small
    rows are summed. The event e is the first row that is small and whose sum
    exceeds F, or big and fits on top of the small rows before it. Before e all
    small rows are admitted and all big ones rejected; at e the big row is
    admitted, the small one rejected. Either way less than F / 2 is left, so a
    key takes at most log2(F in units of money) rounds whatever its rows; the
    rows after e stay pending.
    """
    c = large.join(_per_hot_key(free.withColumnRenamed(key, "_fk"), bounded),
                   F.col(key).eqNullSafe(F.col("_fk")), "left").drop("_fk")
    fits_now = F.coalesce((F.col("_amt") >= 0) & (F.col("_amt") <= F.col("_free")), F.lit(False))
    never = c.filter(~fits_now).select(*cols, F.lit(False).alias("admitted"))
    small = F.col("_amt") * 2 <= F.col("_free")
    cand = (c.filter(fits_now).withColumn("_small", small)
            .withColumn("_val", F.when(small, F.col("_amt")).otherwise(F.lit(0)).cast(MONEY)))
    p = segmented_prefix_sum(cand, key, ts, tie, "_val", segments=segments)
    event = F.when(F.col("_small"), F.col("_s") > F.col("_free")).otherwise(F.col("_s") + F.col("_amt") <= F.col("_free"))
    k = (p.filter(event).groupBy(F.col(key).alias("_ek"))
          .agg(F.min(F.struct(F.col(ts), F.col(tie), F.col("_s"), F.col("_amt"), F.col("_free"), F.col("_small"))).alias("_k")))
    pk = p.join(_per_hot_key(k, bounded), F.col(key).eqNullSafe(F.col("_ek")), "left")
    kk = F.col("_k")
    passed = kk.isNull() | _before(ts, tie, kk)
    at = kk.isNotNull() & _same(ts, tie, kk)
    done = pk.filter(passed | at).select(
        *cols, F.when(passed, F.col("_small")).otherwise(~F.col("_small")).alias("admitted"))
    pending = pk.filter(~passed & ~at).select(*cols, "_amt")
    spent = F.when(kk["_small"], kk["_s"] - kk["_amt"]).otherwise(kk["_s"] + kk["_amt"])
    new_free = k.select(F.col("_ek").alias(key), (kk["_free"] - spent).cast(MONEY).alias("_free"))
    return never.unionByName(done), pending, new_free


# --------------------------------------------------------------------------- TTL dedup

def ttl_first_seen(rows: DataFrame, key: str = "_txnID", ts: str = "timestamp",
                   tie: str = "attempt", ttl_ms: int = 5000, group_rows: int = 4096) -> DataFrame:
    """Keep a row iff no row of its key was *kept* within the last ``ttl_ms``.

    A duplicate does not refresh the TTL (the cache put happens only for kept
    rows). Exact copies are first collapsed by a partial aggregate (a storm of
    identical re-sends becomes one row per map task before the shuffle); the
    order is ``(ts, tie, every other column)``, a total order on distinct rows.
    Returns one row per distinct input row with ``kept`` and ``copies``; only
    the first of the copies of a kept row is kept.

    Keys with at most ``group_rows`` distinct rows are folded in one task; hot
    keys are solved by pointer doubling (``_ttl_doubling``).
    """
    cols = rows.columns
    rest = [c for c in cols if c not in (key, ts, tie)]
    order = [ts] + ([tie] if tie != ts else []) + rest
    out_cols = cols + ["copies"]

    def ordered(part: DataFrame) -> DataFrame:
        distinct = part.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
        return distinct.withColumn("_ord", F.struct(*[F.col(c) for c in order]))

    # rows with their copies bound the distinct rows from above: counting them needs the key alone
    small, large = split_hot_keys(rows, key, group_rows)
    # dealt by key before copies are collapsed: a map task builds no table of all the rows it reads. A number of
    # partitions of its own is neither merged with a join's below nor joined into fewer, larger ones
    dealt = small.repartition(_segments(small, None) + 1, F.col(key))
    out = _fold_ttl(ordered(dealt), key, ts, out_cols, ttl_ms)
    if large is not None:
        out = out.unionByName(_ttl_doubling(ordered(large), key, ts, out_cols, ttl_ms))
    return out


def _fold_ttl(rows: DataFrame, key: str, ts: str, cols: list[str], ttl_ms: int) -> DataFrame:
    item = F.struct(F.col("_ord"), F.struct(*[F.col(c) for c in cols]).alias("_row"))
    g = rows.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    init = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast("array<boolean>").alias("ok"))

    def step(acc, x):
        t = x["_ord"][ts]
        keep = acc["last"].isNull() | (t >= acc["last"] + F.lit(ttl_ms))
        return F.struct(F.when(keep, t).otherwise(acc["last"]).alias("last"),
                        F.array_append(acc["ok"], keep).alias("ok"))

    g = g.withColumn("_ok", F.aggregate("_items", init, step)["ok"])
    z = g.select(F.explode(F.arrays_zip(F.col("_items"), F.col("_ok"))).alias("_z"))
    return z.select(*[F.col("_z._items._row")[c].alias(c) for c in cols], F.col("_z._ok").alias("kept"))


def ttl_successors(nodes: DataFrame, key: str, ttl_ms: int, segments: int | None = None) -> DataFrame:
    """For every row ``(key, _id, _t)``, ``_id`` a number in the key's order: ``_nxt`` = id of the
    first row of the same key with ``_t >= own _t + ttl``, or NULL.

    An as-of lookup: every row is a target at ``_t`` and a probe at
    ``_t + ttl``; in ``(key, time, probe-before-target, _id)`` order the answer
    is the next target after the probe. Targets and probes are range
    partitioned on that order; inside a segment a window partitioned by
    ``(key, segment)`` finds the next target, and a probe with none left in
    its segment takes the first target of the key's next non-empty segment
    (a running window over the small per-segment table). No window spans a
    whole key or a whole time bucket.
    """
    order = [F.col("_time"), F.col("_kind"), F.col("_id")]
    seg = range_segments(_targets_and_probes(nodes, key, ttl_ms), key, order, segments)
    # descending running frame (linear): the last target seen before a probe
    # is the smallest target at or after it
    w = (Window.partitionBy(key, "_seg").orderBy(*[c.desc() for c in order])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inseg = (seg.withColumn("_in", F.last(_target(), ignorenulls=True).over(w))
             .filter(F.col("_kind") == 0)
             .select(key, "_id", "_seg", "_in"))
    # probes with no target left in their segment take the first target of the
    # key's next segment that has one: a running window over the small
    # per-segment table (one row per key and segment)
    firsts = (seg.filter(F.col("_kind") == 1).groupBy(key, "_seg")
              .agg(F.min(F.struct(F.col("_time"), F.col("_id"))).alias("_f"))
              .select(key, "_seg", F.lit(0).alias("_kind"), F.col("_f._id").alias("_v")))
    asks = (inseg.filter(F.col("_in").isNull()).select(key, "_seg").distinct()
            .select(key, "_seg", F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("_v")))
    w2 = (Window.partitionBy(key).orderBy(F.col("_seg").desc(), F.col("_kind").desc())
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fallback = (firsts.unionByName(asks)
                .withColumn("_fb", F.last("_v", ignorenulls=True).over(w2))
                .filter(F.col("_kind") == 1).select(key, "_seg", "_fb"))
    fallback = fallback.select(F.col(key).alias("_fk"), F.col("_seg").alias("_fseg"), "_fb")
    return (inseg.join(fallback, F.col(key).eqNullSafe(F.col("_fk")) & (F.col("_seg") == F.col("_fseg")), "left")
            .select("_id", F.coalesce("_in", "_fb").alias("_nxt")))


def _targets_and_probes(nodes: DataFrame, key: str, ttl_ms: int) -> DataFrame:
    """Every row twice: as a target (``_kind`` 1) at its time and as a probe (0) at the end of its TTL."""
    two = F.array(F.struct(F.col("_t").alias("_time"), F.lit(1).cast("tinyint").alias("_kind")),
                  F.struct((F.col("_t") + F.lit(ttl_ms)).alias("_time"), F.lit(0).cast("tinyint").alias("_kind")))
    return nodes.select(key, "_id", F.explode(two).alias("_x")).select(key, "_x._time", "_x._kind", "_id")


def _target() -> Column:
    return F.when(F.col("_kind") == 1, F.col("_id"))


def _spanning_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys (``_sk``) whose rows lie in more than one segment: at most one per border of two segments."""
    edges = rows.groupBy("_seg").agg(F.min_by(F.struct(key), "_id").alias("_first"), F.max_by(F.struct(key), "_id").alias("_last"))
    w = Window.orderBy("_seg")  # one row per segment
    return (edges.withColumn("_prev", F.lag("_last").over(w)).filter(F.col("_prev").isNotNull() & F.col("_prev").eqNullSafe(F.col("_first")))
            .select(F.col("_first")[key].alias("_sk")).distinct())


def _ttl_doubling(large: DataFrame, key: str, ts: str, cols: list[str], ttl_ms: int) -> DataFrame:
    """Hot keys: the kept rows are the successor chain from the key's first row.

    The rows are sorted by ``(key, _ord)`` over range segments once and numbered in that
    order; every later step moves numbers only. The chain is marked by pointer doubling:
    ``M`` starts as the first rows, ``J`` as the successor links; each round adds ``J(M)`` to
    ``M`` and squares ``J`` (a row without successor leaves it), so a chain of length L is
    marked in about log2(L) rounds. All joins are on row numbers (unique), so a hot key is
    spread evenly over tasks. Successors of keys that lie in one segment are found in a
    window per key, those of the few other keys in range segments (``ttl_successors``).
    """
    n = _segments(large, None)
    rows = cut_lineage(large.repartitionByRange(n, F.col(key), F.col("_ord")).sortWithinPartitions(key, "_ord")
                       .select(*cols, F.spark_partition_id().alias("_seg"), F.monotonically_increasing_id().alias("_id")))
    spanning = cut_lineage(_spanning_keys(rows, key))
    cond = F.col(key).eqNullSafe(F.col("_sk"))
    nodes = rows.select(key, "_id", F.col(ts).alias("_t"))
    within, across = (nodes.join(F.broadcast(spanning), cond, how) for how in ("left_anti", "left_semi"))
    w = (Window.partitionBy(key).orderBy(F.desc("_time"), F.desc("_kind"), F.desc("_id"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    jump = (_targets_and_probes(within, key, ttl_ms).withColumn("_nxt", F.last(_target(), ignorenulls=True).over(w))
            .filter(F.col("_kind") == 0).select("_id", "_nxt"))
    if not spanning.isEmpty():
        jump = jump.unionByName(ttl_successors(across, key, ttl_ms))
    jump = cut_lineage(jump.filter(F.col("_nxt").isNotNull()))
    marked = cut_lineage(rows.groupBy(key).agg(F.min("_id").alias("_id")).select("_id"))
    while True:
        step = marked.join(jump, "_id").select(F.col("_nxt").alias("_id"))
        new = cut_lineage(step.join(marked, "_id", "left_anti"))
        if new.isEmpty():
            break
        marked = marked.unionByName(new)
        a, b2 = jump.alias("a"), jump.alias("b")
        jump = cut_lineage(a.join(b2, F.col("a._nxt") == F.col("b._id"))
                           .select(F.col("a._id").alias("_id"), F.col("b._nxt").alias("_nxt")))
    flagged = rows.join(marked.withColumn("_m", F.lit(True)), "_id", "left")
    return flagged.select(*cols, F.coalesce(F.col("_m"), F.lit(False)).alias("kept"))
