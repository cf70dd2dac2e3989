"""Joins on ``%`` patterns that are data: literal keys cut the candidates before ``like``.

Every distinct pattern has some keys that a text it matches must have: the text before its first
wildcard, the text after the last one, and every stretch of up to four characters of the
literals between them; a pattern of wildcards alone has the empty key, which a text of the right
length matches anyway. The pattern is looked up by the one of them that the fewest texts have,
counted over all texts, so a literal that every text has (a common prefix) never pairs every
text with every pattern. A text has the keys of the shapes (kind and length) that some pattern
has, so it makes at most (kinds * length of the longest pattern) keys for the ends and four per
character, whatever the number of patterns, and text and pattern meet in an equi-join. ``like``
then decides, once per distinct pattern; the rows of a pattern are joined to the pairs found.

Up to ``broadcast_patterns`` patterns are broadcast (proved by a bounded count); more are dealt
``salts`` times and a text meets the copy of its own salt, so a key that very many texts have
is spread over ``salts`` tasks.

``%`` stands for any text and ``_`` for one character; there is no escape character. A NULL
text or pattern matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payflux.session import cut_lineage

_GRAM = 4


def _candidate_keys(patterns: DataFrame) -> DataFrame:
    """The distinct patterns with each key (``kind``: p, s, g or a, ``len`` and ``key``) that can find them."""
    parts = F.split("pattern", "[%_]+")
    head, tail = F.element_at(parts, 1), F.element_at(parts, -1)
    one = lambda kind, key: F.struct(F.lit(kind).alias("kind"), F.length(key).alias("len"), key.alias("key"))
    n_inner = F.greatest(F.size(parts) - 2, F.lit(0))
    inner = F.filter(F.slice(parts, F.lit(2), n_inner), lambda x: F.length(x) > 0)
    grams = F.flatten(F.transform(inner, lambda x: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(x) - _GRAM + 1, F.lit(1))), lambda i: one("g", F.substr(x, i, F.lit(_GRAM))))))
    ends = F.filter(F.array(one("p", head), one("s", tail)), lambda k: k["len"] > 0)
    keys = F.array_distinct(F.concat(ends, grams))
    return (patterns.select("pattern").where("pattern is not null").distinct()
            .select("pattern", F.explode(F.when(F.size(keys) > 0, keys).otherwise(F.array(one("a", F.lit(""))))).alias("k"))
            .select("pattern", "k.*"))


def _keys_of(text: Column, kind: str, n: int) -> Column:
    """The keys of one shape that a text has."""
    if kind == "a":
        return F.array(F.lit(""))
    enough = F.length(text) >= n
    if kind == "g":
        grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, F.lit(n))))
        return F.when(enough, grams).otherwise(F.array().cast("array<string>"))
    piece = F.left(text, F.lit(n)) if kind == "p" else F.right(text, F.lit(n))
    return F.when(enough, F.array(piece)).otherwise(F.array().cast("array<string>"))


def pattern_join(texts: DataFrame, patterns: DataFrame, text: str, pattern: str,
                 broadcast_patterns: int = 100_000, salts: int = 32) -> DataFrame:
    """Every pair of a row of ``texts`` and a row of ``patterns`` with ``text LIKE pattern``: the columns of both."""
    left = texts.select(F.struct("*").alias("t"), F.col(text).alias("text")).where("text is not null")
    rows = patterns.select(F.struct("*").alias("p"), F.col(pattern).alias("pattern")).where("pattern is not null")
    few = rows.limit(broadcast_patterns + 1).count() <= broadcast_patterns
    can = _candidate_keys(rows)
    shapes = sorted((r["kind"], r["len"]) for r in can.select("kind", "len").distinct().collect())
    tagged = lambda kind, n: lambda k: F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("len"), k.alias("key"))
    keys = F.concat(*[F.transform(_keys_of(F.col("text"), kind, n), tagged(kind, n)) for kind, n in shapes or [("a", 0)]])
    on = ["kind", "len", "key"]
    # how many texts have a key: of those, the pattern takes the key that the fewest have
    probed = left.select(F.explode(keys).alias("probe")).select("probe.*")
    if can.limit(10 * broadcast_patterns + 1).count() <= 10 * broadcast_patterns:
        probed = probed.join(F.broadcast(can.select(*on).distinct()), on, "left_semi")
    seen = probed.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    known = cut_lineage(can.join(seen, on, "left").groupBy("pattern")
                        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), *on)).alias("k"))
                        .where("k.n > 0").select("pattern", *[F.col(f"k.{c}").alias(c) for c in on]))
    probes = left.select("t", "text", F.explode(keys).alias("probe")).select("t", "text", "probe.*")
    # no escape character: a backslash of the pattern stands for itself
    like = F.expr(r"text like replace(pattern, r'\', r'\\')")
    if few:
        met = probes.join(F.broadcast(known), on).where(like).join(F.broadcast(rows), "pattern")
    else:
        dealt = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = (probes.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(salts)).cast("int"))
               .join(dealt(known), [*on, "salt"]).where(like).join(dealt(rows), ["pattern", "salt"]))
    return met.select("t.*", "p.*")
