"""A cleaning pipeline over ``documents``: quality rules, near-duplicates, benchmark passages,
secrets, packing. Every stage reads the Parquet that the stage before wrote.

The first four return the columns of documents: rows that a stage rejects are left out whole, and
the secret scan replaces secrets in the text (and sets n_chars accordingly). The last returns the
packed pieces. Rows with NULLs, empty texts or repeated rows are treated as each operator states; an
empty table runs through to an empty result. Columns beyond those of documents are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import decontaminate, packing, quality, secrets_crf, setsketch, shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that fail the base rule or a risk-controlled threshold."""
    shared.ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_rows(docs, labels, shared.workspace(spark, "stage-quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id of each component of near-duplicates, NULL ids last.

    Rows are told apart by a number of their own, so repeated ids and NULL ids are rows like any other.
    """
    shared.ship(spark)
    folder = shared.workspace(spark, "stage-duplicates")
    rows = docs.select(F.monotonically_increasing_id().alias("_number"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    rows = shared.staged(rows, folder, "numbered")
    numbered = rows.select(F.col("_number").alias("doc_id"), F.col("_row.text").alias("text"))
    found = setsketch.near_duplicates(numbered, folder).select(F.col("doc_id").alias("_found"), "component_id")
    found = shared.staged(found, folder, "components")
    ids = rows.select("_number", F.col("_row.doc_id").alias("_id")).join(found, F.col("_number") == F.col("_found"))
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_number")).getField("_number").alias("_kept")
    kept = shared.staged(ids.groupBy("component_id").agg(first).select("_kept"), folder, "kept")
    # The list grows with the documents, so it is not broadcast at any size.
    left = rows.join(kept.hint("merge"), rows["_number"] == kept["_kept"], "left_semi")
    return left.select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that overlap a benchmark item."""
    shared.ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, items, shared.workspace(spark, "stage-benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts."""
    shared.ship(spark)
    # The other columns travel in a struct, so that no name of theirs can clash.
    others = [c for c in docs.columns if c != "text"]
    rest = F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row")
    found = secrets_crf.scan(docs.select(rest, "text"), secrets_crf.train(docs), ["_row", "text"], with_text=True)
    changed = F.size("spans") > 0
    new = {"text": F.when(changed, F.col("masked")).otherwise(F.col("text"))}
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.char_length("masked").cast(kind)).otherwise(F.col("_row.n_chars"))
    return found.select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens."""
    shared.ship(spark)
    return packing.packed_documents(docs, shared.workspace(spark, "stage-packing"), "byte_bpe_50k.json", end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secret_scan),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again."""
    folder = shared.workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.staged(stage(spark, docs, sf_dir), folder, name.replace(" ", "-"))
    return docs
