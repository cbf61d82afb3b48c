"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlend.llm import (
    ann,
    bpe,
    exact_search,
    language_id,
    line_dedup,
    merkle,
    near_dups,
    packing,
    periodic_runs,
    product_codes,
    secret_scan,
    suffix_dedup,
    token_files,
)
from airlend.llm.common import shared_folder, ship, stage
from airlend.llm.sql import SQL
from airlend.llm.vectors import whole

LIBRARY_FILE = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicate_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/llm/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(_documents(spark, sf_dir), path, public_tokenizers.path(LIBRARY_FILE), end_id=0)
    found = token_files.read_tokens(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the documents, from which language identification does not learn."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language_id.train(docs.where(~held_out()).select("text", "lang"))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = secret_scan.find(docs, secret_scan.train(secret_scan.labelled_samples(docs)))
    kinds = F.transform("base", lambda span: span["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in secret_scan.PATTERNS
    ]
    digest = F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.written(F.col("spans")).alias("spans"))


def op6_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.edited_fingerprints(_documents(spark, sf_dir))
    columns = ("fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *columns)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANK_FILE)
    encoded = bpe.encode(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    vectors = ann.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return ann.Index(vectors).search(vectors.where(F.col("id") % 50 == 0), k=5)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(_documents(spark, sf_dir), words=3, per_hundred=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(_documents(spark, sf_dir), public_tokenizers.path(LIBRARY_FILE), end_id=2)
    return packing.best_fit(pieces)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.select(F.col("vec_id").alias("id"), "label", whole(F.col("embedding"), 4096).alias("v"))
    rows = stage(rows.where(F.col("v").isNotNull()), "whole-vectors")
    codes = product_codes.ProductCodes.fit(rows)
    found = product_codes.with_label_error(stage(codes.encode(rows), "codes"))
    digest = F.lit(codes.sha256()).alias("codebooks_sha256")
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", digest)


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), whole(F.col("embedding"), 256).alias("v"))
    vectors = exact_search.usable(rows)
    return exact_search.top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(periodic_runs.with_repeated_tails(_documents(spark, sf_dir)))
    top = periodic_runs.longest(F.col("runs"))
    found = found.withColumn("top", top).select("*", "top.*")
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_line_dedup,
        op2_token_files,
        op3_suffix_dedup,
        op4_language_id,
        op5_secret_scan,
        op6_merkle_fingerprints,
        op7_byte_bpe,
        op8_ann,
        op9_near_duplicates,
        op10_best_fit_packing,
        op11_vector_codes,
        op12_exact_top_k,
        op13_periodic_runs,
    ]
    return {**{query.__name__: query for query in found}, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {**SQL, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
