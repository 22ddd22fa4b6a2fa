"""A corpus pipeline: quality, exact copies, near copies, source mix, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and
returns a DataFrame that is written as Parquet and read again as the next one's docs. All but
the last return the columns of documents; the mix repeats a document's row for each copy that
it takes, and the packing returns where each piece of it lies.

Rows pass through unchanged, extra columns included. A null text counts as empty (and so is
rejected by the first stage); repeated rows are copies of each other; an empty table passes
through all stages as an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm.common import SPACE, documents, keep, semi_filter, settle, text_of
from tilewright.llm.exact_dedup import exact_dedup
from tilewright.llm.jaccard_join import jaccard_join
from tilewright.llm.mixing import mix
from tilewright.llm.packing import pack
from tilewright.llm.quality import keep_good
from tilewright.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the weak-label classifier rejects."""
    settle(spark)
    return keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    settle(spark)
    found = keep(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "copies")
    dropped = keep(found.where("not kept").select(F.col("doc_id").alias("gone_id")).distinct(), "dropped")
    # only rows whose id may be a dropped one's are looked up by their text
    sure, unsure = (semi_filter(docs, dropped, "doc_id", "gone_id", how) for how in ("left_anti", "left_semi"))
    kept = found.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    body = F.regexp_replace(text_of(), f"[{SPACE}]+", " ")
    rows = unsure.withColumn("_sha_", F.sha2(body.cast("binary"), 256))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows["_sha_"] == kept["kept_sha"]), "left_semi")
    if not found.groupBy("doc_id", "text_sha256").count().where("count > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "_sha_"])  # repeated rows
    return sure.unionByName(rows.drop("_sha_"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays.

    Rows without a doc_id stay if they are linked with none that has one; of rows with one
    doc_id all stay if one does.
    """
    settle(spark)
    found = keep(jaccard_join(docs).select("doc_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("first")).distinct(), "near")
    others = found.where("not first").select(F.col("doc_id").alias("gone_id"))
    firsts = found.where("first").select(F.col("doc_id").alias("first_id"))
    sure, unsure = (semi_filter(docs, others, "doc_id", "gone_id", how) for how in ("left_anti", "left_semi"))
    return sure.unionByName(unsure.join(firsts, unsure["doc_id"].eqNullSafe(firsts["first_id"]), "left_semi"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the copies of a row are alike."""
    settle(spark)
    # rows with the same doc_id and source are taken alike
    copies = mix(docs).where("copies > 0").select(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("copies").cast("int").alias("_copies_")).distinct()
    rows = docs.join(copies, docs["doc_id"].eqNullSafe(copies["mix_id"]) & docs["source"].eqNullSafe(copies["mix_source"]))
    return rows.select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), copies["_copies_"])).alias("_copy_")).drop("_copy_")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of at most 2048 tokens."""
    settle(spark)
    # the workers of a long run hold less, so that its executors keep within their memory
    return pack(docs, tokenizer_path(), remembered=1 << 17, at_once=1 << 20)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: The stages learn weights, draw and pack; SQL can't express them. tests/llm hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are a table in the shared scratch folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
