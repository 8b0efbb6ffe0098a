"""Brand dictionary and brand matching (SRC4, SRT3, SRT4, SET2, JN13, UDF6).

Dictionary lines: line_no, value (one ragged CSV line). Aliases: alias, brand_group.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from shelfspark.functions.text import strip
from shelfspark.session import pinned

# The first-word score a brand needs, in percent.
FIRST_WORD_SCORE = 90
# A score rounds up from half a percent below, so the distance may reach this share (in 1/1000) of both lengths.
_MAX_SHARE = 1000 - (10 * FIRST_WORD_SCORE - 5)
# Up to this length three deletions per side reach every pair that scores high enough.
_DELETION_LENGTH = 21


# ---- dictionary -----------------------------------------------------------

def read_brand_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with a key that follows file and line order."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return lines.select(F.struct("file_path", "file_block_start", F.monotonically_increasing_id().alias("row")).alias("line_no"), "value")


def csv_cells(line: Column) -> Column:
    """Trimmed cells of one CSV line; a cell that starts with a quote may hold commas and doubled quotes."""
    cells = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'("(?:[^"]|"")*"[^,]*|[^,]*),'), F.lit(1))
    quoted = r'(?s)^"((?:[^"]|"")*)"(.*)$'

    def bare(c: Column) -> Column:
        inner = F.replace(F.regexp_extract(c, quoted, 1), F.lit('""'), F.lit('"'))
        return F.when(c.rlike(quoted), F.concat(inner, F.regexp_extract(c, quoted, 2))).otherwise(c)

    return F.transform(cells, lambda c: strip(bare(c)))


def alias_table(lines: DataFrame) -> DataFrame:
    """(alias, brand_group): first cell names the group, a later line wins a repeated alias (SRC4)."""
    rows = lines.withColumn("cells", csv_cells(F.col("value"))).where(F.get("cells", F.lit(0)) != "")
    rows = rows.select("line_no", F.get("cells", F.lit(0)).alias("brand_group"), F.explode("cells").alias("alias")).where("alias <> ''")
    return rows.groupBy("alias").agg(F.max_by("brand_group", "line_no").alias("brand_group"))


def sorted_brands(*lists: DataFrame) -> DataFrame:
    """All brands once, sorted without regard to case (SRT3). Each list: brand."""
    out = lists[0].select("brand")
    for more in lists[1:]:
        out = out.union(more.select("brand"))
    return out.distinct().withColumn("_key", F.lower("brand")).orderBy("_key", "brand").drop("_key")


def added_brands(brands: DataFrame, more: DataFrame) -> DataFrame:
    """Existing brands and the new ones that are missing, each new one once (SET2)."""
    return brands.select("brand").union(more.select("brand").distinct().join(brands.select("brand"), "brand", "left_anti"))


def longest(aliases: DataFrame, keys: list[str]) -> DataFrame:
    """Longest alias per key, the alphabetically first of equal ones (SRT4)."""
    return aliases.groupBy(*keys).agg(F.min_by("alias", _longest_first()).alias("alias"))


def _longest_first() -> Column:
    return F.struct(-F.length("alias"), F.col("alias"))


# ---- text preparation -----------------------------------------------------

def tokens(text: Column) -> Column:
    """Lower-case word tokens, other characters as blanks, then ASCII only."""
    plain = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}_]", " "))
    ascii_only = F.regexp_replace(plain, r"[^\x00-\x7F]", "")
    return F.filter(F.split(ascii_only, r"\s+"), lambda w: w != "")


def sorted_text(text: Column) -> Column:
    return F.array_join(F.array_sort(tokens(text)), " ")


# ---- similarity -----------------------------------------------------------

def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word per character of ``b``."""
    places: dict[str, int] = {}
    for i, char in enumerate(a):
        places[char] = places.get(char, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for char in b:
        hit = free & places.get(char, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - bin(free).count("1")


def similarity(a: str, b: str) -> int:
    """Percent of both lengths that the common subsequence covers."""
    total = len(a) + len(b)
    return int(200.0 * common_length(a, b) / total + 0.5) if total else 0


@F.pandas_udf(IntegerType())
def similarity_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype="int32")


# ---- stage 1: first word --------------------------------------------------

def _shorter(words: Column) -> Column:
    """All texts with one more character deleted."""
    cut = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.left(w, i - 1), F.substring(w, i + 1, F.length(w))))
    return F.array_distinct(F.flatten(F.transform(words, cut)))


def _deletions(word: str) -> Column:
    """The word and everything left after the deletions its length allows."""
    w = F.col(word)
    none = F.array().cast("array<string>")
    # d deletions on one side need a length of at least d / 0.19, see allowed_deletions.
    levels = [F.array(w)]
    for d in (1, 2, 3):
        levels.append(F.when(allowed_deletions(F.length(w)) >= d, _shorter(levels[-1])).otherwise(none))
    return F.concat(*levels)


def allowed_deletions(length: Column) -> Column:
    """Most characters one side may lose and still reach the score: share·(2n − d) ≥ 1000·d."""
    return F.floor(length * (2 * _MAX_SHARE) / (1000 + _MAX_SHARE))


def _score(common: Column, a: Column, b: Column) -> Column:
    return F.floor(common * 200.0 / (a + b) + 0.5).cast("int")


def _short_matches(words: DataFrame, aliases: DataFrame) -> DataFrame:
    """Pairs that share a text after deletions; the dictionary side keeps its best alias per text and length.

    Two texts are similar enough exactly if deleting few characters on each side leaves the
    same text, so the equi-join yields matches only and no pair needs a second look.
    """
    short = F.length("key") <= _DELETION_LENGTH
    left = words.where(short).select("key", F.explode(_deletions("key")).alias("left"))
    right = aliases.where(short).select("alias", F.length("key").alias("_b"), F.explode(_deletions("key")).alias("left"))
    right = longest(right, ["left", "_b"])
    rows = left.join(right, "left").withColumn("score", _score(F.length("left"), F.length("key"), F.col("_b")))
    return rows.where(F.col("score") >= FIRST_WORD_SCORE).select("key", "alias", "score")


#: Lengths of long aliases are indexed in tiers, each this much longer than the one before.
_TIER = 1.125


def _tier(length: Column) -> Column:
    return F.floor(F.log(length) / math.log(_TIER)).cast("int")


def _long_matches(words: DataFrame, aliases: DataFrame) -> DataFrame:
    """Pairs with a long side: one piece of the alias must appear in the word near its place.

    Aliases of similar length make a tier. In a tier all are cut into pieces of one size, one piece more than the edits that any
    match of the tier allows, so a match leaves at least one piece whole. A word is cut once per tier in its reach, not once per
    length. Only pairs that share a piece reach the similarity function.
    """
    share = 2 * _MAX_SHARE / (1000 - _MAX_SHARE)
    least = int(_DELETION_LENGTH * (1000 - _MAX_SHARE) / (1000 + _MAX_SHARE))
    long_alias = aliases.where(F.length("key") >= least).select("alias", F.col("key").alias("akey"), _tier(F.length("key")).alias("tier"))
    # The tier's own shortest and longest alias: one row per tier that has any.
    tiers = long_alias.groupBy("tier").agg(F.min(F.length("akey")).alias("_short"), F.max(F.length("akey")).alias("_long"))
    tiers = tiers.withColumn("_edits", F.floor(F.col("_long") * share).cast("int")).withColumn("_size", F.floor(F.col("_short") / (F.col("_edits") + 1)).cast("int"))
    pieces = F.sequence(F.lit(0), F.col("_edits"))

    def cut(text: str, at: Column) -> Column:
        return F.substring(F.col(text), at + 1, F.col("_size"))

    right = long_alias.join(tiers, "tier").select("alias", "akey", "tier", "_size", F.explode(pieces).alias("i"))
    right = right.select("alias", "akey", "tier", "i", cut("akey", F.col("i") * F.col("_size")).alias("piece"))
    n = F.length("key")
    near = F.sequence(_tier(F.greatest(F.lit(least), F.floor(n / (1 + share)))) - 1, _tier(F.ceil(n * (1 + share))) + 1)
    left = words.where(n >= least).select("key", F.explode(near).alias("tier")).join(tiers, "tier")
    left = left.where((F.col("_short") <= F.ceil(n * (1 + share))) & (F.col("_long") >= F.floor(n / (1 + share))))
    left = left.select("key", "tier", "_size", "_edits", F.explode(pieces).alias("i"))
    at = F.col("i") * F.col("_size")
    low, high = F.greatest(F.lit(0), at - F.col("_edits")), F.least(n - F.col("_size"), at + F.col("_edits"))
    left = left.where(low <= high).select("key", "tier", "i", "_size", F.explode(F.sequence(low, high)).alias("_at"))
    left = left.select("key", "tier", "i", cut("key", F.col("_at")).alias("piece")).distinct()
    pairs = left.join(right, ["tier", "i", "piece"]).select("key", "alias", "akey").distinct()
    pairs = pairs.where((F.length("key") > _DELETION_LENGTH) | (F.length("akey") > _DELETION_LENGTH))
    return pairs.withColumn("score", similarity_udf("key", "akey")).where(F.col("score") >= FIRST_WORD_SCORE).select("key", "alias", "score")


def first_word_matches(titles: DataFrame, aliases: DataFrame) -> DataFrame:
    """(first word, alias): the best alias for the first word, compared with sorted tokens.

    Each distinct first word is matched once, however many titles start with it.
    """
    words = titles.select(first_word(F.col("title")).alias("word")).distinct().withColumn("key", sorted_text(F.col("word")))
    distinct = words.where("key <> ''").select("key").distinct()
    keyed = aliases.select("alias", sorted_text(F.col("alias")).alias("key")).where("key <> ''")
    found = _short_matches(distinct, keyed).unionByName(_long_matches(distinct, keyed))
    best = found.groupBy("key").agg(F.min_by("alias", F.struct(-F.col("score"), _longest_first())).alias("alias"))
    return words.join(best, "key").select("word", "alias")


def first_word(title: Column) -> Column:
    return F.substring_index(title, " ", 1)


# ---- stage 2: whole title -------------------------------------------------

#: A word that more rows of the other side have is hot: rows whose words are all hot meet at pairs of them.
HOT_WORD = 10_000


def _inside(inner: DataFrame, key: str, words: str, outer: DataFrame, outer_key: str, outer_words: str, hot: int) -> DataFrame:
    """(key, outer_key) where all ``words`` are among ``outer_words``; both are sorted sets.

    A row meets the other side at its rarest word there. If even that is hot, it meets at its rarest two words, which far fewer
    rows have together than one alone; the other side then offers pairs of hot words only. A single hot word needs no second look:
    all it meets contain it.
    """
    words_of = outer.select(outer_key, outer_words, F.explode(outer_words).alias("word"))
    counts = pinned(words_of.groupBy("word").agg(F.count("*").alias("_n")))
    # Words the other side lacks rule the row out: its words found there must be all of them.
    ranked = inner.select(key, words, F.explode(words).alias("word")).join(counts, "word").groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("_n", "word"))).alias("_w"), F.first(words).alias(words))
    ranked = ranked.where(F.size("_w") == F.size(words))
    nth = lambda i: F.get("_w", F.lit(i))
    alone = (F.size("_w") == 1) | (nth(0)["_n"] <= hot)
    at_word = ranked.where(alone).select(key, words, nth(0)["word"].alias("word")).join(words_of, "word")
    both = F.concat_ws(" ", F.array_sort(F.array(nth(0)["word"], nth(1)["word"])))
    hot_words = words_of.join(counts.where(F.col("_n") > hot).select("word"), "word").groupBy(outer_key).agg(
        F.array_sort(F.collect_list("word")).alias("_h"), F.first(outer_words).alias(outer_words))
    pairs = F.flatten(F.transform("_h", lambda x, i: F.transform(F.slice("_h", i + 2, F.size("_h")), lambda y: F.concat_ws(" ", x, y))))
    at_pair = ranked.where(~alone).select(key, words, both.alias("word")).join(hot_words.select(outer_key, outer_words, F.explode(pairs).alias("word")), "word")
    met = at_word.select(key, words, outer_key, outer_words).unionByName(at_pair.select(key, words, outer_key, outer_words))
    return met.where(F.size(F.array_except(words, outer_words)) == 0).select(key, outer_key)


def contained_matches(titles: DataFrame, aliases: DataFrame, hot: int = HOT_WORD) -> DataFrame:
    """(title_key, alias): longest alias whose words all occur in the title, or the other way round.

    Each distinct set of title words is matched once. Aliases are expected to be shorter than 200 characters, where a full score
    always means containment.
    """
    sets = titles.select(F.array_sort(F.array_distinct(tokens(F.col("title")))).alias("words")).where("size(words) > 0")
    sets = sets.select(F.array_join("words", " ").alias("title_key"), "words").distinct()
    known = aliases.select("alias", F.array_sort(F.array_distinct(tokens(F.col("alias")))).alias("alias_words")).where("size(alias_words) > 0")
    known = longest(known, ["alias_words"])
    inside = _inside(known, "alias", "alias_words", sets, "title_key", "words", hot)
    around = _inside(sets, "title_key", "words", known, "alias", "alias_words", hot)
    return longest(inside.unionByName(around), ["title_key"])


def title_key(title: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(tokens(title))), " ")


def guess_brands(titles: DataFrame, aliases: DataFrame) -> DataFrame:
    """Adds ``brand``: group of the first-word match, else of the longest contained alias (JN13).

    ``titles``: title and any keys.
    """
    groups = aliases.select("alias", "brand_group")
    by_word = pinned(first_word_matches(titles, aliases).join(groups, "alias").select("word", F.col("brand_group").alias("_b1")))
    rows = titles.withColumn("word", first_word(F.col("title"))).join(by_word, "word", "left").drop("word")
    rest = rows.where("_b1 IS NULL").select("title")
    by_set = contained_matches(rest, aliases).join(groups, "alias").select("title_key", F.col("brand_group").alias("_b2"))
    # Titles matched by their first word get a key no title has, spread over all partitions.
    settled = F.concat(F.lit("\u0000"), F.xxhash64("title").cast("string"))
    key = F.when(F.col("_b1").isNull(), title_key(F.col("title"))).otherwise(settled)
    rows = rows.withColumn("title_key", key).join(by_set, "title_key", "left").drop("title_key")
    return rows.withColumn("brand", F.coalesce("_b1", "_b2")).drop("_b1", "_b2")


def fill_brands(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """Guessed brands for the items that have a title and no brand; all other rows and values stay."""
    missing = F.coalesce(F.col("title") != "", F.lit(False)) & (F.coalesce("brand", F.lit("")) == "")
    titles = items.where(missing).select("title").distinct()
    guessed = guess_brands(titles, aliases).where("brand IS NOT NULL").select("title", F.col("brand").alias("_guess"))
    # Rows that need no guess get a key no title has, so that they spread over all partitions.
    key = F.when(missing, F.col("title")).otherwise(F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(f"`{c}`") for c in items.columns]).cast("string")))
    rows = items.withColumn("_title", key).join(guessed.withColumnRenamed("title", "_title"), "_title", "left")
    return rows.withColumn("brand", F.coalesce("_guess", "brand")).drop("_title", "_guess")
