"""From documents to packed training sequences: STAGES, each written as Parquet and read again for the next.

Every stage takes and, but for the last, returns the columns of documents, whatever else they hold; n_chars
follows the text where it is there. An empty table gives an empty one.

1. language_id drops documents without a letter and those whose language is told with a score under MIN_SCORE;
   if no row has a language to learn from, all documents with letters stay.
2. line_dedup deletes later repeats of runs of lines; documents of which nothing is left go.
3. near_duplicates keeps the document with the least id of each group (five words, similarity 0.8), of those with
   one id or none that with the least hash of its text; documents without words are no duplicates. Rows that repeat
   id and text are one document.
4. secret_scan masks secrets.
5. packing gives a row for each piece of a document: its sequence and place there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlend.llm import language_id, line_dedup, near_dups, packing, secret_scan
from airlend.llm.common import ship, stage, unpacked, with_keys

MIN_SCORE = 0.3
TOKENIZER = "byte_bpe_50k.json"

#: No SQL: language scores and the language model's fit, MinHash components and tokens can't be written in it.
ORACLE_SQL = None


def _whole(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang and all columns as one struct, so that none clashes with what an operator adds."""
    return docs.select("doc_id", "text", "lang", F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents again, with the new text."""
    changed = {"text": F.col("text")}
    if "n_chars" in rows.schema["row"].dataType.fieldNames():
        old = F.col("row.n_chars")
        same = F.col("text").eqNullSafe(F.col("row.text"))
        changed["n_chars"] = F.when(same, old).otherwise(F.length("text").cast(rows.schema["row"].dataType["n_chars"].dataType))
    return unpacked(rows, **changed)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = language_id.train(docs.select("text", "lang"))
    if not model.langs:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    found = language_id.predict(_whole(docs), model)
    kept = found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_SCORE))
    return _documents(kept)


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicate_lines(_whole(docs))
    return _documents(found.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = near_dups.near_duplicates(docs.select("doc_id", "text"))
    found = stage(found.select("label", F.struct(F.col("doc_id").isNull().alias("no_id"), "dk", "th").alias("one")), "groups")
    firsts = found.where("label is not null").groupBy("label").agg(F.min("one").alias("one")).select("one")
    kept = firsts.unionByName(found.where("label is null").select("one")).select("one.dk", "one.th").distinct()
    return unpacked(with_keys(docs).join(kept, ["dk", "th"], "left_semi").dropDuplicates(["dk", "th"]))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _whole(docs)
    ratios = secret_scan.train(secret_scan.labelled_samples(rows))
    return _documents(secret_scan.redact(secret_scan.find(rows, ratios)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.best_fit(packing.token_pieces(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", delete_repeated_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
