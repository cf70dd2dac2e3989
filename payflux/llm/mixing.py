"""Operator 1: mix sources to target weights by systematic sampling.

Every document of a source gets the same expected copies, target / source size.
Within a source the documents stand in order of size (then of a hash of the id),
their expected copies are prefix-summed, one random offset of the source is
added, and a document is emitted once per whole number its interval crosses.
Ordered by size, the words taken from a source differ from its target by less
than the size of its largest document.

Defined results: a null text has size 0; a null source is a source of its own,
after all others; rows that repeat are mixed as separate documents; an empty
table gives an empty result; a source without words has target 0; rows of equal
size stand in the order of a hash of the id, then of the id; texts of any length are
counted whole. ``mix`` keeps the input's columns, whatever their names;
``mix_decisions`` reads the id, text and source alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payflux.llm.common import WORD, stored

#: Copies are counted in units of 2**-24, in whole numbers, so that reruns and any split agree.
UNIT = 1 << 24


def size_of(text: str | Column = "text") -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_key(source: str | Column = "source") -> Column:
    """The source as a non-null key in code point order, null last."""
    c = F.col(source) if isinstance(source, str) else source
    return F.when(c.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), c))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """Targets per source: ``(skey, n, source_size, target)`` from ``(skey, n, source_size)``.

    The sources share ``share`` (a fraction) of all words by weight; a target
    stops at ``most`` times its source and the excess is reshared by weight.
    That fixed point is a water level: with sources ordered by limit / weight,
    the full ones are a prefix, found by two running sums. One row per source.
    """
    num, den = share
    one = Window.partitionBy(F.lit(0))
    order = one.orderBy("skey")
    level = one.orderBy("ratio", "skey")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    rest = level.rowsBetween(0, Window.unboundedFollowing)
    pick = F.lit(0)
    for i, w in enumerate(weights):
        pick = F.when((F.row_number().over(order) - 1) % len(weights) == i, F.lit(w)).otherwise(pick)
    big = "decimal(38,0)"
    x = sizes.withColumn("w", pick.cast("bigint")).withColumn("full", F.col("source_size") * most)
    x = x.withColumn("ratio", F.col("full") / F.col("w"))
    x = (x.withColumn("total", F.sum("source_size").over(one))
          .withColumn("full_before", F.coalesce(F.sum("full").over(before), F.lit(0)))
          .withColumn("w_rest", F.sum("w").over(rest)))
    # level here = (share * total - full before) / weights from here on, as num / den
    x = x.withColumn("lnum", F.col("total") * num - F.col("full_before") * den).withColumn("lden", F.col("w_rest") * den)
    x = x.withColumn("below", F.col("lnum").cast(big) * F.col("w") <= F.col("lden").cast(big) * F.col("full"))
    x = x.withColumn("first", F.min(F.when(F.col("below"), F.struct("ratio", "skey", "lnum", "lden"))).over(one))
    after = F.struct("ratio", "skey") >= F.struct(F.col("first.ratio"), F.col("first.skey"))
    return x.select("skey", "n", "source_size", F.when(
        after, (F.col("first.lnum") * F.col("w")).cast("double") / F.col("first.lden").cast("double"))
        .otherwise(F.col("full").cast("double")).alias("target"))


def mix_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights: tuple[int, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2), most: int = 2,
                  seed: str = "mix") -> DataFrame:
    """Copies of every document: id, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    The order within a source is a position in whole numbers, built from three
    counts: of smaller sizes, of earlier hash ranges of the same size, and the
    row number within such a range. Hash ranges (about the root of the row count)
    split a hot source and a hot size, so no task holds more than a small part
    of one; the per-range tables are pre-aggregated.
    """
    rows = stored(docs.select(F.col(id_col).alias("id"), source_key(source_col).alias("skey"),
                              size_of(text_col).alias("size"),
                              F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("h")),
                  "mix-rows")
    digits = max(1, math.ceil(math.log(max(rows.count(), 1)) / math.log(16) / 2))
    seg = F.substring("h", 1, digits).alias("seg")

    sources = targets(rows.groupBy("skey").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")),
                      weights, share, most)
    step = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT + F.lit(0.5)))
    start = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), "skey").cast("binary")), 1, 6), 16, 10)
    sources = sources.withColumn("step", F.coalesce(step, F.lit(0)).cast("bigint")).withColumn("start", start.cast("bigint"))

    by_size = Window.partitionBy("skey").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    by_seg = Window.partitionBy("skey", "size").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    segs = rows.groupBy("skey", "size", seg).agg(F.count("*").alias("c"))
    sizes = (segs.groupBy("skey", "size").agg(F.sum("c").alias("c"))
             .withColumn("o1", F.coalesce(F.sum("c").over(by_size), F.lit(0))).drop("c"))
    segs = segs.withColumn("o2", F.coalesce(F.sum("c").over(by_seg), F.lit(0))).drop("c")
    offsets = (segs.join(sizes, ["skey", "size"]).join(sources, "skey")
               .select("skey", "size", "seg", (F.col("o1") + F.col("o2")).alias("o"), "source_size", "target", "step", "start"))

    within = Window.partitionBy("skey", "size", "seg").orderBy("h", "id")
    at = lambda p: F.shiftright(p * F.col("step") + F.col("start"), 24)
    out = (rows.withColumn("seg", seg).withColumn("r", F.row_number().over(within))
           .join(offsets, ["skey", "size", "seg"]).withColumn("p", F.col("o") + F.col("r"))
           .withColumn("copies", at(F.col("p")) - at(F.col("p") - 1)))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixed rows: ``docs`` with every row repeated by its copies (0 to ``most`` times).

    Rows are numbered in a stored table first, so that repeated ids and rows stay apart.
    """
    numbered = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "mix-docs")
    sized = numbered.select("row", F.col("doc").getField(text_col).alias("text"), F.col("doc").getField(source_col).alias("source"))
    copies = mix_decisions(sized, "row", **how).where("copies > 0").select("row", "copies")
    return (numbered.join(copies, "row").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc.*"))
