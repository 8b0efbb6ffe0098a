"""Text rules: slugs, term matching, html cleanup, descriptions, lists (FN12-FN20, FN30, PRJ7, SET4)."""

from __future__ import annotations

import html.entities
import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def drop_line_controls(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"[\n\t\r]", ""))


@lru_cache(maxsize=1)
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Compatibility folds of all of Unicode: one-letter and longer ones."""
    one, many = {}, {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        folded = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            one[char] = folded
        elif len(folded) > 1:
            many[char] = folded
    return one, many


def _literal_map(pairs: dict[str, str]) -> Column:
    """One foldable expression instead of a literal per entry."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def ascii_fold(text: Column) -> Column:
    """Accents and compatibility forms to ASCII; what has no ASCII form is dropped."""
    one, many = _ascii_folds()
    table = _literal_map(many)
    foreign = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    spelled = F.when(
        F.length(F.translate(foreign, "".join(many), "")) < F.length(foreign),
        F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"(?s)(.)"), F.lit(1)), lambda c: F.coalesce(F.try_element_at(table, c), c)), ""),
    ).otherwise(text)
    return F.regexp_replace(F.translate(spelled, "".join(one), "".join(one.values())), r"[^\x00-\x7F]", "")


def slug(title: Column) -> Column:
    """ASCII words joined by single dashes; plain ASCII titles skip the fold."""
    folded = F.when(title.rlike(r"[^\x00-\x7F]"), ascii_fold(title)).otherwise(title)
    kept = strip(F.regexp_replace(folded, r"[^\w\s-]", ""))
    return F.regexp_replace(kept, r"[-\s]+", "-")


def normal_term(text: Column) -> Column:
    """ASCII only, no punctuation, lower case, trimmed; currency and math signs stay."""
    ascii_only = F.regexp_replace(text, r"[^\x00-\x7F]+", "")
    return strip(F.lower(F.regexp_replace(ascii_only, r"\p{P}", "")))


def words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def words_within(term: Column, title: Column) -> Column:
    return F.size(F.array_except(words(term), words(title))) == 0


def term_in_title(term: Column, title: Column) -> dict[str, Column]:
    term_n, title_n = normal_term(term), normal_term(title)
    return {
        "exactly": F.contains(title_n, term_n),
        "partial": words_within(term_n, title_n),
        "interleaved": F.lit(False),
    }


def between(text: Column, first: str, last: str) -> Column:
    """Text between two markers, '' when either is missing."""
    start = F.instr(text, first)
    rest = F.substring(text, start + len(first), F.length(text))
    stop = F.instr(rest, last)
    return F.when((start > 0) & (stop > 0), F.substring(rest, F.lit(1), stop - 1)).otherwise("")


def strip_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, r"<[^>]*>", "")


def has_text(markup: Column) -> Column:
    return F.coalesce(strip_tags(markup) != "", F.lit(False))


@lru_cache(maxsize=1)
def _entities() -> dict[str, str]:
    return {f"&{name};": chr(code) for name, code in html.entities.name2codepoint.items()}


def unescape(markup: Column) -> Column:
    """One pass over named and numeric entities of any length; unknown ones and numbers beyond Unicode stay.

    Two numeric entities that are the halves of a surrogate pair make one character; a lone half stays.
    """
    table = _literal_map(_entities())

    def char(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")

    def number(entity: Column) -> Column:
        """Code of a numeric entity; null when the text is none or the number is beyond Unicode."""
        digits = F.regexp_extract(entity, r"^&#0*(\d{1,7});$", 1)
        hexes = F.regexp_extract(entity, r"^&#[xX]0*([0-9a-fA-F]{1,6});$", 1)
        code = F.when(digits != "", digits.cast("int")).when(hexes != "", F.conv(hexes, 16, 10).cast("int"))
        return F.when(code <= 0x10FFFF, code)

    def spelled(code: Column) -> Column:
        return char(F.hex(code.cast("bigint")))

    def plain(token: Column) -> Column:
        code = number(token)
        high, low = (number(F.regexp_extract(token, r"^(&#\w+;)(&#\w+;)$", k)) for k in (1, 2))
        return (
            F.when(~token.startswith("&"), token)
            .when(high.isNotNull() & low.isNotNull(), spelled((high - 0xD800) * 0x400 + (low - 0xDC00) + 0x10000))
            .when(code.isNotNull() & ~code.between(0xD800, 0xDFFF), spelled(code))
            .otherwise(F.coalesce(F.try_element_at(table, token), token))
        )

    # Halves of surrogate pairs: 55296-56319 or d800-dbff, then 56320-57343 or dc00-dfff.
    high = r"&#(?:0*(?:5529[6-9]|55[3-9]\d\d|56[0-2]\d\d|563[01]\d)|[xX]0*[dD][89abAB][0-9a-fA-F]{2});"
    low = r"&#(?:0*(?:563[2-9]\d|56[4-9]\d\d|57[0-2]\d\d|573[0-3]\d|5734[0-3])|[xX]0*[dD][c-fC-F][0-9a-fA-F]{2});"
    tokens = F.regexp_extract_all(markup, F.lit(rf"({high}{low}|&#?\w+;|[^&]+|&)"), F.lit(1))
    return F.when(markup.contains("&"), F.array_join(F.transform(tokens, plain), "")).otherwise(markup)


def clean_markup(markup: Column) -> Column:
    """Unlink, drop attributes, div and span, undo entities, trim; other tags stay."""
    # What the clean-up takes out, in this order.
    text = F.regexp_replace(markup, r"(?d)<a href.*?>(.*?)</a>", "$1")
    text = F.regexp_replace(text, r"(<\w+)[^>]*?(/?>)", "$1$2")
    text = F.regexp_replace(text, r"</?div>|</?span>", "")
    text = F.regexp_replace(text, "�", "")
    text = F.replace(text, F.lit("&nbsp;"), F.lit(" "))
    return strip(unescape(text))


def plain_text(markup: Column) -> Column:
    return strip_tags(unescape(markup))


def bullet_columns(bullets: Column, width: int = 20) -> dict[str, Column]:
    """``bullet_feature_1`` .. ``bullet_feature_<width>`` and the count."""
    lines = F.when(bullets != "", F.split(bullets, "\n"))
    out = {f"bullet_feature_{i + 1}": F.get(lines, F.lit(i)) for i in range(width)}
    out["bullet_feature_count"] = F.when(lines.isNull(), 0).otherwise(F.size(lines))
    return out


def ingredients_outside_parens(text: Column) -> Column:
    """Parts between commas, keeping bracketed lists together."""
    parts = F.regexp_extract_all(text, F.lit(r"(?:[^,(]+|\([^)]*\))+"), F.lit(0))
    return F.transform(parts, strip)


def ingredients_flat(text: Column) -> Column:
    """Brackets count as commas; blanks are dropped."""
    parts = F.transform(F.split(F.regexp_replace(text, "[()]", ","), ","), strip)
    return F.filter(parts, lambda p: p != "")


def ingredients_unless_no(text: Column) -> Column:
    given = (text != "") & (F.lower(text) != "no")
    return F.when(given, F.transform(F.split(text, ","), strip))


def department_path(text: Column, drop_root: bool = True) -> Column:
    parts = F.split(text, r"\|")
    return F.slice(parts, 2, 2**31 - 1) if drop_root else parts


# Where a combined description turns from short to long.
_ALWAYS_SPLIT = ("<h3>", '<section class="product-about')
_SPLIT_WITHOUT_NAME = ("<dl>", "<ul>", "<li>")
_NAME_PATTERN = r'(?s)(<b>|<strong>)[^<]*(</b>|</strong>)[(<br>)\s":]*(</p>)?(<br>)*(<ul>|<li>)'
_SHORT_LIMIT = 1000
_NO_LONG_TEXT = "long description is not available"


def _found(description: Column, marker: Column) -> Column:
    """0-based position or null."""
    at = F.position(marker, description)
    return F.when(at > 0, at - 1)


def split_point(description: Column, title: Column) -> Column:
    """0-based position where the long part starts, null when nothing splits it."""
    name = F.substring_index(title, ",", 1)
    bold = _found(description, F.concat(F.lit("<b>"), name))
    strong = _found(description, F.concat(F.lit("<strong>"), name))
    named = bold.isNotNull() | strong.isNotNull()
    block = F.regexp_extract(description, _NAME_PATTERN, 0)
    block_at = F.when(~named & (block != ""), _found(description, block))
    has_name = named | (block != "")
    ends = [bold, strong, block_at]
    ends += [_found(description, F.lit(m)) for m in _ALWAYS_SPLIT]
    ends += [F.when(~has_name, _found(description, F.lit(m))) for m in _SPLIT_WITHOUT_NAME]
    return F.least(*ends)


def shortened_end(description: Column, end: Column) -> Column:
    """Move an end beyond the limit back to the last paragraph start within it, else to the first one."""
    kept = F.coalesce(end, F.length(description))
    short = F.substring(description, F.lit(1), kept)
    head = F.left(short, F.lit(_SHORT_LIMIT + len("<p>")))
    from_back = F.instr(F.reverse(head), ">p<")
    last_near = F.when(from_back > 0, F.length(head) - from_back + 1 - len("<p>"))
    first = F.instr(short, "<p>")
    return F.when((kept > _SHORT_LIMIT) & (first > 0), F.coalesce(last_near, first - 1)).otherwise(end)


def choose_descriptions(df: DataFrame, short: list[str], long: list[str], title: str = "title") -> DataFrame:
    """Add ``short_description`` and ``long_description`` from candidate markup columns, best first."""

    def best(names: list[str]) -> Column:
        return F.coalesce(*[F.when(has_text(F.col(n)), clean_markup(F.col(n))) for n in names])

    df = df.withColumns({"_s": best(short), "_l": best(long)})
    df = df.withColumns({
        "_s": F.when((F.col("_s") != "") & ~F.col("_s").endswith("..."), F.col("_s")),
        "_l": F.when((F.col("_l") != "") & (F.lower("_l") != _NO_LONG_TEXT), F.col("_l")),
    })
    is_title = F.coalesce(F.col("_l") == F.col(title), F.lit(False))
    df = df.withColumns({
        "_s": F.when(is_title, F.concat_ws(" ", F.col("_s"), F.col("_l"))).otherwise(F.col("_s")),
        "_l": F.when(~is_title, F.col("_l")),
    })
    no_short = F.col("_s").isNull()
    df = df.withColumns({
        "_s": F.coalesce("_s", "_l"),
        "_l": F.when(~no_short, F.col("_l")),
    })
    df = df.withColumn("_end", split_point(F.col("_s"), F.col(title)))
    df = df.withColumn("_end", shortened_end(F.col("_s"), F.col("_end")))
    cut = F.col("_l").isNull() & (F.col("_end") > 0)
    return df.withColumns({
        "short_description": F.when(cut, F.left("_s", F.col("_end"))).otherwise(F.col("_s")),
        "long_description": F.when(cut, F.substring(F.col("_s"), F.col("_end") + 1, F.length("_s"))).otherwise(F.col("_l")),
    }).drop("_s", "_l", "_end")
