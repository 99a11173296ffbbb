"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bin_packing,
    bond_scan,
    cap_filters,
    compact_windows,
    dimension_scan,
    line_dedup,
    order_minhash,
    piece_codec,
    quality,
    spelling,
    token_counts,
    token_files,
    toxicity,
)
from ledgerloom.llm.stage import Scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_line_dedup", line_dedup.ORACLE_SQL.format(documents="documents"))
def line_dedup_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.digest(line_dedup.dedup_lines(docs, Scratch(spark, "line-dedup")))


@query("op2_token_files")
def token_file_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "token-files")
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), scratch.path("files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, path, 2, scratch)
    return token_files.digest(token_files.read_token_files(spark, folder))


@query("op3_cap_filters")
def near_vector_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"), Scratch(spark, "cap-filters"))


@query("op4_token_counts")
def token_count_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_piece_codec")
def piece_codec_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_order_minhash")
def near_document_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_documents(table(spark, sf_dir, "documents"), Scratch(spark, "order-minhash"))


@query("op7_bin_packing")
def bin_packing_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = bin_packing.token_pieces(table(spark, sf_dir, "documents"), path, 1, crc=True)
    return bin_packing.assign(Scratch(spark, "bin-packing").save(pieces, "pieces"))


@query("op8_dimension_scan")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.col("vec_id") % 50 == 0
    return dimension_scan.nearest(table(spark, sf_dir, "embeddings"), Scratch(spark, "dimension-scan"), asked)


@query("op9_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op10_compact_windows")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeats(table(spark, sf_dir, "documents"), Scratch(spark, "compact-windows"))


@query("op11_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Scratch(spark, "quality").save(quality.with_statistics(table(spark, sf_dir, "documents")), "statistics")
    scored = quality.score_statistics(rows, quality.train(rows, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op12_spelling_variants", spelling.ORACLE_SQL.format(documents="documents"))
def spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), Scratch(spark, "spelling"), every=199)


@query("op13_bond_negatives", bond_scan.ORACLE_SQL.format(embeddings="embeddings"))
def hard_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    mislabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", mislabelled)
    return bond_scan.hard_negatives(rows, Scratch(spark, "bond-scan"), F.col("vec_id") % 100 == 0)
