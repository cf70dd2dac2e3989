"""The registered queries of the corpus operators, over whole tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payflux.llm import (
    ann,
    arc,
    embed_dedup,
    jaccard,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    spelling,
    substring,
    token_counts,
    toxicity,
    url_rules,
)
from payflux.llm.common import table
from payflux.llm.oracles import ORACLE_SQL  # noqa: F401
from payflux.session import ensure_checkpoint_dir

VOCABULARY = "word_bpe_49k.json"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix_decisions(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "copies"))


def op2_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{ensure_checkpoint_dir(spark)}/archives/{uuid.uuid4().hex}"
    arc.write_arc(table(spark, sf_dir, "pages"), f"{root}/arc")
    arc.write_warc(arc.convert(arc.read_arc(spark, f"{root}/arc")), f"{root}/warc")
    return (arc.resolved(arc.read_warc(spark, f"{root}/warc", with_payload=False))
            .select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op5_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op6_heavy_light_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.clusters(table(spark, sf_dir, "documents"))


def op7_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)))


def op8_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op9_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), plant=True)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), plant=True)


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), url_rules.rules_of(spark, url_rules.RULES)).drop("url")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_e8_lattice": op2_e8_lattice,
    "op3_fuzzy_lines": op3_fuzzy_lines,
    "op4_arc_to_warc": op4_arc_to_warc,
    "op5_collision_counting": op5_collision_counting,
    "op6_heavy_light_jaccard": op6_heavy_light_jaccard,
    "op7_vector_best_fit": op7_vector_best_fit,
    "op8_difference_cover": op8_difference_cover,
    "op9_ftrl_toxicity": op9_ftrl_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_url_rules": op13_url_rules,
}
