"""Operator 13: URL rules by hashed host-suffix and path-prefix expressions, in DataFrame functions only.

A rule names a host, a path and a verdict. It fits a URL whose host is the rule's or
a subdomain of it and whose path starts with the rule's. A URL is expanded into
expressions, a suffix of its host joined with a prefix of its path. Expressions and
rules meet in an equi-join on the first eight hex digits of their SHA-256 and fit if
the whole digests agree. Of the rules that fit, the longest (host and path together)
decides, of equally long ones the one with the longer host; a rule given with both
verdicts blocks. A URL that no rule fits gets the verdict ``otherwise`` ("allow": a
list of rules speaks only of what it lists).

Only expressions of a shape that some rule has are made: a number of host labels and a
length of the path. There are at most (labels of the longest rule host) * (characters
of the longest rule path) shapes, whatever the number of rules or pages.

Equal addresses (host and path) are judged once. The rules are broadcast up to
``broadcast_rules`` of them, proved by a bounded count; beyond that they are dealt
``salts`` times, and an address meets the copy of its own salt, so an expression that a
third of all addresses share is spread over ``salts`` tasks.

Defined results: the host lies between the first ``://`` and the next ``/``, ``?``, ``#``
or the end, A to Z in lower case; the path follows up to ``?``, ``#`` or the end, and is
empty or begins with ``/``. A null URL, or one without ``://``, has an empty host and path.
An empty host fits no rule. Rows are judged one by one, so repeated rows and null ids stay
as they are; very long URLs are judged whole; an empty table gives no rows. A rule with a
null or empty host, a path that is neither empty nor begins with ``/``, or a verdict other
than allow and block fits nothing; a null path counts as empty. The input's columns stay,
also those named like the operator's own inner columns; a column named like one of its
results (host, path, rule, verdict) is replaced by the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHORT = 8
RESULTS = ("host", "path", "rule", "verdict")

#: The rules of the registered query: host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def rules_of(spark: SparkSession, rules: list[tuple[str | None, str | None, str | None]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    found = lambda k: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", k), F.lit(""))
    return _lower(found(1)), found(2)


def labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def prepared(rules: DataFrame) -> DataFrame:
    """(short, digest, best): one row per rule that can fit, ``best`` in order of precedence."""
    host, path = _lower(F.col("host")), F.coalesce("path", F.lit(""))
    return (rules.select(host.alias("host"), path.alias("path"), "verdict")
            .where("host <> '' and (path = '' or startswith(path, '/')) and verdict in ('allow', 'block')")
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block comes after allow
            .select("host", "path", "verdict", F.concat("host", "path").alias("rule"))
            .select(labels(F.col("host")).alias("labels"), F.length("path").alias("chars"), F.sha2("rule", 256).alias("digest"),
                    F.struct(F.length("rule").alias("long"), F.length("host").alias("wide"), "rule", "verdict").alias("best"))
            .withColumn("short", F.substring("digest", 1, _SHORT)))


def expressions(addresses: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """(host, path, expression): for every shape that an address has, its host's last labels and its path's first characters."""
    have = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).alias("c")) for n, c in shapes])
    return (addresses.where("host <> ''").select("host", "path", labels(F.col("host")).alias("labels"), F.length("path").alias("chars"), F.explode(have).alias("s"))
            .where("labels >= s.n and chars >= s.c")
            .select("host", "path", F.expr("concat(substring_index(host, '.', -s.n), substring(path, 1, s.c))").alias("expression")))


def verdicts(addresses: DataFrame, rules: DataFrame, broadcast_rules: int = 200_000, salts: int = 32) -> DataFrame:
    """(host, path, rule, verdict): the addresses that some rule fits and the rule that decides."""
    known = prepared(rules)
    shapes = sorted((r.labels, r.chars) for r in known.select("labels", "chars").distinct().collect())
    if not shapes:
        return addresses.select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict")).limit(0)
    made = (expressions(addresses, shapes).withColumn("digest", F.sha2("expression", 256))
            .select("host", "path", "digest", F.substring("digest", 1, _SHORT).alias("short")))
    known = known.select("short", F.col("digest").alias("whole"), "best")
    if known.limit(broadcast_rules + 1).count() <= broadcast_rules:
        met = made.join(F.broadcast(known), "short")
    else:
        met = (made.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)))
               .join(known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))), ["short", "salt"]))
    return (met.where("digest = whole").groupBy("host", "path").agg(F.max("best").alias("best"))
            .select("host", "path", "best.rule", "best.verdict"))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", otherwise: str = "allow", broadcast_rules: int = 200_000, salts: int = 32) -> DataFrame:
    """``pages`` with the columns host, path, rule (null: none fits) and verdict."""
    host, path = host_and_path(url_col)
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in RESULTS]).alias("row"), host.alias("host"), path.alias("path")) \
        if set(pages.columns) - set(RESULTS) else pages.select(F.struct(F.lit(0)).alias("row"), host.alias("host"), path.alias("path"))
    found = verdicts(rows.select("host", "path").distinct(), rules, broadcast_rules, salts)
    return (rows.join(found, ["host", "path"], "left")
            .select(*[F.col(f"row.`{c}`") for c in pages.columns if c not in RESULTS], "host", "path", "rule",
                    F.coalesce("verdict", F.lit(otherwise)).alias("verdict")))
