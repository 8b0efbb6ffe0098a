"""All values of a key at any depth of JSON texts (FN28).

Texts are cut into brackets, keys that may be the wanted one, and what lies between; windows over these pieces give each its
place, its depth and the bracket it belongs to. No text is parsed into a tree, so depth has no limit, values come out as they
are written, and a long text is a run of rows.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.operators.groups import keyed
from shelfspark.session import written

# Possessive throughout: the pattern never steps back, whatever the length of a string.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_ESCAPED = r'[^"\\]*+\\.(?:[^"\\]++|\\.)*+'
_SCALAR = rf"(?s)^({_STRING}|[^,\s\]}}]++)"
#: Spark's JSON reader refuses texts nested deeper; there, only the brackets are checked.
READER_DEPTH = 1000


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_\x80-\U0010ffff])", r"\\\1", text)


def _patterns(key: str) -> tuple[str, str]:
    """What may be the key with its colon (also spelled with escapes), and how a text is cut."""
    plain = json.dumps(key, ensure_ascii=False)[1:-1]
    spelled = _ESCAPED if "\\" in plain else f"{_quoted(plain)}|{_ESCAPED}"
    named = rf'"(?:{spelled})"\s*+:\s*+'
    return named, rf'(?s){named}|[\[{{\]}}]|(?:[^"\[\]{{}}]++|(?!{named}){_STRING})++'


def with_deep_values(df: DataFrame, document: str, key: str, out: str) -> DataFrame:
    """``df`` with ``out``: array<string> of the key's values as written, in document order.

    An object that has the key yields its value, the last one if it has several, and is not searched further. The list is empty
    without a hit, for null and for broken JSON. Only texts that mention the key, plainly or with escapes, are cut into pieces.
    """
    rows = keyed(df)
    named, cut = _patterns(key)
    text = F.col(document)
    mentioned = rows.where(text.contains(json.dumps(key, ensure_ascii=False)) | text.contains("\\"))
    reads = F.coalesce(F.json_object_keys(text).isNotNull(), F.lit(False)) | F.coalesce(F.json_array_length(text).isNotNull(), F.lit(False))
    pieces = mentioned.select("_row", F.length(text).alias("_size"), reads.alias("_reads"), F.posexplode(F.regexp_extract_all(text, F.lit(cut), F.lit(0))).alias("_i", "_piece"))

    piece = F.col("_piece")
    opens, closes = piece.isin("{", "["), piece.isin("}", "]")
    unescaped = F.get(F.from_json(F.concat(F.lit("["), F.regexp_extract(piece, f"(?s)^{_STRING}", 0), F.lit("]")), "array<string>"), F.lit(0))
    candidate = piece.startswith('"') & piece.rlike(f"(?s)^{named}$")
    is_key = candidate & F.when(piece.contains("\\"), F.coalesce(unescaped == key, F.lit(False))).otherwise(True)
    pieces = pieces.withColumns({"_opens": opens, "_closes": closes, "_key": is_key})
    document_rows = Window.partitionBy("_row").orderBy("_i")
    before, so_far = (document_rows.rowsBetween(Window.unboundedPreceding, n) for n in (-1, 0))
    placed = pieces.withColumns({
        "_at": F.coalesce(F.sum(F.length("_piece")).over(before), F.lit(0)),
        "_depth": F.sum(F.col("_opens").cast("int") - F.col("_closes").cast("int")).over(so_far),
        "_next": F.when(F.col("_key"), F.lead("_piece").over(document_rows))})

    # A text that the reader takes is well formed up to its end; one too deep for it must at least close what it opens, and hold no
    # stray quote. Neither may go on after that.
    sound = placed.groupBy("_row").agg(
        (F.bool_or("_reads") | (F.max("_depth") >= READER_DEPTH)).alias("_fits"), F.min("_depth").alias("_least"), F.max_by("_depth", "_i").alias("_end"),
        (F.sum(F.length("_piece")) == F.max("_size")).alias("_whole"), F.count_if(F.col("_closes") & (F.col("_depth") == 0)).alias("_roots"),
        F.bool_or((F.col("_depth") == 0) & ~F.col("_closes") & ~piece.rlike(r"^[ \t\r\n]*+$")).alias("_stray"))
    sound = sound.where("_fits AND _least >= 0 AND _end = 0 AND _whole AND _roots = 1 AND NOT _stray").select("_row")

    kept = placed.where("_opens OR _closes OR _key").withColumn("_level", F.col("_depth") + F.col("_closes").cast("int"))
    same_level = Window.partitionBy("_row", "_level").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    kept = kept.withColumn("_nth", F.sum(F.col("_opens").cast("int")).over(same_level))
    bracket = Window.partitionBy("_row", "_level", "_nth")
    kept = kept.withColumns({
        "_start": F.min(F.when(F.col("_opens"), F.col("_at"))).over(bracket), "_stop": F.max(F.when(F.col("_closes"), F.col("_at") + 1)).over(bracket),
        "_last": F.max(F.when(F.col("_key"), F.col("_i"))).over(bracket)})
    # The piece after a key is its value's first; if that is a bracket, its own stop ends the value.
    kept = kept.withColumn("_value_stop", F.lead("_stop").over(document_rows)).where("_key AND _i = _last")
    above = Window.partitionBy("_row").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    hits = kept.withColumn("_covered", F.coalesce(F.max("_stop").over(above), F.lit(0))).where("_start >= _covered")
    container = F.col("_next").isin("{", "[")
    from_ = F.col("_at") + F.length("_piece")
    found = hits.join(sound, "_row").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(
        "_i", F.when(~container, F.regexp_extract("_next", _SCALAR, 1)).alias("scalar"), (from_ + 1).cast("int").alias("at"),
        (F.col("_value_stop") - from_).cast("int").alias("size")))).alias("_hits"))
    found = written(found, "hits")
    value: Column = F.transform("_hits", lambda h: F.coalesce(h["scalar"], F.substring(text, h["at"], h["size"])))
    joined = rows.join(found.hint("shuffle_hash"), "_row", "left")
    return joined.withColumn(out, F.coalesce(value, F.array().cast("array<string>"))).drop("_row", "_hits")
