"""From raw documents to packed training sequences: five stages, each stored as Parquet before the next reads it.

Stages take ``(spark, docs, sf_dir)``. All but the last return the columns of ``docs``. A row is known by its ``doc_id`` and its
text: what a stage decides holds for the rows with both, whether or not others share the id, or have none.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfspark.llm import decontamination, jaccard_join, packing, queries, ranking_quality, secrets
from shelfspark.llm.common import ready, small_side, stored

#: No SQL: a trained model, a compressor and a tokenizer take part. The tests hold it against a brute-force version.
ORACLE_SQL = None


def key_of() -> Column:
    """What names a row: its id, rows without one last, and a hash of its text. Of two rows, that with the smaller id is less."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))


def keyed(docs: DataFrame) -> DataFrame:
    """Key, as ``doc_id``, and text of each row."""
    return docs.select(key_of().alias("doc_id"), "text")


def without_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not among ``keys`` (column ``doc_id``)."""
    gone = small_side(stored(keys.select(F.col("doc_id").alias("_gone")).distinct(), "gone"))
    return docs.join(gone, key_of().eqNullSafe(gone["_gone"]), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = ranking_quality.quality_scores(keyed(docs), queries.table(spark, sf_dir, "labels"), field="id")
    return without_rows(docs, scored.where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows tied by a Jaccard similarity of 0.8 over word 5-grams, one with the smallest key stays, rows without id last.

    Each row stands for itself: rows that share an id but differ in text are different documents, and rows without words stay.
    Of rows alike in id and text one stays.
    """
    found = jaccard_join.jaccard_join(keyed(docs), size=5, num=80, den=100, links=False).select("doc_id", "n_shingles", "component_id")
    found = stored(found, "components")
    kept = without_rows(docs, found.where("doc_id <> component_id"))
    repeated = found.where("n_shingles > 0 AND doc_id = component_id").groupBy(F.col("doc_id").alias("_key")).count().where("count > 1")
    repeated = stored(repeated.select("_key"), "repeated")
    if repeated.isEmpty():
        return kept
    repeated = small_side(repeated)
    alike = kept.join(repeated, key_of().eqNullSafe(repeated["_key"]), "left_semi").withColumn("_text_hash", F.xxhash64("text"))
    first = alike.dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash")
    return kept.join(repeated, key_of().eqNullSafe(repeated["_key"]), "left_anti").unionByName(first)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word run of a benchmark item go, also where words were put into it."""
    found = decontamination.matches(keyed(docs), queries.table(spark, sf_dir, "benchmark"), near=decontamination.NEAR)
    return without_rows(docs, found.where((F.col("n_hit") > 0) | (F.size(decontamination.near_spans()) > 0)))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each secret gives way to a mark; ``n_chars``, where there is one, follows the text."""
    clean = secrets.redacted(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, each with its sequence and place."""
    return packing.packed(docs, queries.tokenizer_path(queries.WORD_BPE), end_id=1, tokens=4096)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
