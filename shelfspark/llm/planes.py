"""Token ids in binary files: fixed-size blocks, transposed into bit or byte planes, each plane compressed.

One file row is a chunk of whole documents in ascending id order. Its ids are cut into blocks of ``block`` ids (the last
one shorter); each block is turned into planes, from the lowest to the highest that any id of the chunk uses, and each plane
is a zstandard frame. The row holds the frames in a row and the chunk index: where each frame starts, the documents and
their numbers of ids. Chunks are numbered inside their range partition, so ``(part, chunk)`` is document order.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import id_type, map_rows, texts_of
from shelfspark.llm.encoding import worker_encoder


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """Planes of one block of unsigned 32-bit ids, lowest first; planes above the largest id are left out."""
    if unit == "byte":
        raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    else:
        raw = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    top = int(ids.max(initial=0)).bit_length()
    used = max(1, -(-top // 8) if unit == "byte" else top)
    planes = np.ascontiguousarray(raw[:, :used].T)
    return [p.tobytes() if unit == "byte" else np.packbits(p, bitorder="little").tobytes() for p in planes]


def from_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    if unit == "byte":
        raw = np.zeros((n, 4), dtype=np.uint8)
        for k, p in enumerate(planes):
            raw[:, k] = np.frombuffer(p, dtype=np.uint8)
        return raw.reshape(-1).view("<u4")
    bits = np.zeros((n, 32), dtype=np.uint8)
    for k, p in enumerate(planes):
        bits[:, k] = np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


def pack_chunk(ids: np.ndarray, block: int, unit: str, level: int) -> tuple[bytes, list[int], list[int]]:
    """Frames in a row, where each starts (and the last ends), and the number of planes of each block."""
    import zstandard

    press, frames, planes_of = zstandard.ZstdCompressor(level=level), [], []
    for i in range(0, len(ids), block):
        planes = to_planes(ids[i : i + block], unit)
        planes_of.append(len(planes))
        frames += [press.compress(p) for p in planes]
    return b"".join(frames), np.cumsum([0, *map(len, frames)]).tolist(), planes_of


def unpack_chunk(data: bytes, starts: list[int], planes_of: list[int], n_ids: int, block: int, unit: str) -> np.ndarray:
    import zstandard

    open_, at, out = zstandard.ZstdDecompressor(), 0, [np.zeros(0, dtype="<u4")]
    for k, used in enumerate(planes_of):
        planes = [open_.decompress(data[starts[j] : starts[j + 1]]) for j in range(at, at + used)]
        out.append(from_planes(planes, min(block, n_ids - k * block), unit))
        at += used
    return np.concatenate(out)


def write_planes(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, block: int = 16_384, chunk_ids: int = 262_144,
    unit: str = "byte", level: int = 3,
) -> None:
    """Encode ``docs``, append ``end_id`` to each document and write the chunks to ``path``.

    Null texts are empty ones, null ids come first, rows with the same id stay next to each other in text order of their
    ids. A chunk takes documents until it holds ``chunk_ids`` ids; only a longer document makes a larger chunk.
    """
    kind = id_type(docs)
    ordered = (
        texts_of(docs).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
        .withColumn("part", F.spark_partition_id())
    )
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(batches):
        encoder, part, chunk, held, size, ids = worker_encoder(tokenizer), 0, 0, [], 0, []

        def row():
            all_ids = np.frombuffer(b"".join(held), dtype="<u4")
            data, starts, planes_of = pack_chunk(all_ids, block, unit, level)
            return {
                "part": [part], "chunk": [chunk], "n_ids": [len(all_ids)], "block": [block], "unit": [unit],
                "planes_of": [planes_of], "starts": [starts], "doc_ids": [ids], "doc_sizes": [[len(h) // 4 for h in held]],
                "data": [data],
            }

        for b in batches:
            if b["part"]:
                part = b["part"][0]
            for doc_id, coded in zip(b["doc_id"], encoder.encode(b["text"]), strict=True):
                held.append(coded + end)
                ids.append(doc_id)
                size += len(held[-1]) // 4
                if size >= chunk_ids:
                    yield row()
                    chunk, held, size, ids = chunk + 1, [], 0, []
        if held:
            yield row()

    schema = (
        "part int, chunk int, n_ids bigint, block int, unit string, planes_of array<int>, starts array<bigint>, "
        f"doc_ids array<{kind}>, doc_sizes array<bigint>, data binary"
    )
    map_rows(ordered, rows, schema, batch=500).write.option("compression", "none").parquet(path)


def chunk_index(files: DataFrame) -> DataFrame:
    """``part, chunk, n_ids`` and ``first``: the number of ids in all chunks before. Sums run inside each part and over the parts."""
    index = files.select("part", "chunk", "n_ids")
    before = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("_all"))
    parts_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_all").over(parts_before), F.lit(0)).alias("_above"))
    inside = index.withColumn("_inside", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return inside.join(parts, "part").select("part", "chunk", "n_ids", (F.col("_above") + F.col("_inside")).alias("first"))


def read_planes(spark, path: str) -> DataFrame:
    """Read the files back: ``doc_id, start, n_tokens, ids_crc32`` for each document, from its decoded ids."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def rows(batches):
        for b in batches:
            for k in range(len(b["part"])):
                ids = unpack_chunk(b["data"][k], b["starts"][k], b["planes_of"][k], b["n_ids"][k], b["block"][k], b["unit"][k])
                sizes = np.array(b["doc_sizes"][k], dtype=np.int64)
                ends = np.cumsum(sizes)
                yield {
                    "part": [b["part"][k]] * len(sizes), "chunk": [b["chunk"][k]] * len(sizes), "doc_id": b["doc_ids"][k],
                    "_at": ends - sizes, "n_tokens": sizes,
                    "ids_crc32": [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, sizes)],
                }

    schema = f"part int, chunk int, doc_id {kind}, _at bigint, n_tokens bigint, ids_crc32 bigint"
    decoded = map_rows(files, rows, schema, batch=8)
    return decoded.join(chunk_index(files).drop("n_ids"), ["part", "chunk"]).select(
        "doc_id", (F.col("first") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")


def binary_output(docs: DataFrame, path: str, tokenizer: str, end_id: int, **options) -> DataFrame:
    write_planes(docs, path, tokenizer, end_id, **options)
    return read_planes(docs.sparkSession, path)
