"""Token counts through a digest cache: each distinct text is encoded once per tokenizer version, ever.

The cache is a Parquet folder of (``version``, ``digest``, ``n_tokens``). A text's digest is SHA-256 over its normalised
form; here that only turns null into the empty text, since the tokenizers tell white space, case and Unicode forms apart.
The version is SHA-256 over the tokenizer file, its kind and the encoding options, so a changed file meets no old counts.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import map_rows, stored, texts_of

CACHE_SCHEMA = "version string, digest string, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(b"plain;" + path.rpartition(".")[2].encode() + b";" + f.read()).hexdigest()


def counter(path: str):
    """``list of texts -> list of counts`` for a ``.model`` (sentencepiece) or ``.json`` (tokenizers) file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def token_counts(docs: DataFrame, path: str, cache_path: str, limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit, digest``.

    Only texts whose digest has no count of this tokenizer version in ``cache_path`` (made if absent) are encoded, each
    distinct one once; their counts are appended. A null text counts as empty, an empty table gives an empty result,
    repeated rows and repeated or null ids keep a row each. A second append of the same digest does no harm: readers
    take one count per digest.
    """
    spark = docs.sparkSession
    version = tokenizer_version(path)
    texts = texts_of(docs).withColumn("digest", F.sha2("text", 256))
    keyed = stored(texts.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")), "keyed")

    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("version") == version)
    # One row stands for each unknown digest. Its text is fetched by (id, digest), which never repeats a hot digest.
    chosen = keyed.groupBy("digest").agg(F.min("doc_id").alias("_id")).join(cache, "digest", "left_anti")
    chosen = chosen.withColumnRenamed("digest", "_digest").hint("shuffle_hash")
    missing = texts.join(chosen, texts["doc_id"].eqNullSafe(chosen["_id"]) & (texts["digest"] == chosen["_digest"]), "left_semi")

    def encode(batches):
        count, seen = counter(path), set()
        for b in batches:
            new = {d: t for d, t in zip(b["digest"], b["text"], strict=True) if d not in seen}
            seen.update(new)
            yield {"version": [version] * len(new), "digest": list(new), "n_tokens": count(list(new.values()))}

    map_rows(missing.select("digest", "text"), encode, CACHE_SCHEMA, batch=500).write.mode("append").parquet(cache_path)
    known = (
        spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("version") == version)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )
    return keyed.join(known, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "digest")
