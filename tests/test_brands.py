import random

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import brands


def distance(a, b):
    """Insertions and deletions between two texts, by the textbook table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] if x == y else 1 + min(row[j], new[-1]))
        row = new
    return row[-1]


def score(a, b):
    total = len(a) + len(b)
    return int(100.0 * (total - distance(a, b)) / total + 0.5) if total else 0


def edited(rnd, word, n):
    for _ in range(n):
        i = rnd.randrange(len(word) + 1)
        word = word[:i] + rnd.choice("abcde") + word[i:] if rnd.random() < 0.5 or len(word) < 3 else word[:i] + word[i + 1:]
    return word


def test_similarity_equals_textbook_distance():
    rnd = random.Random(3)
    for _ in range(500):
        a = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 70)))
        b = edited(rnd, a, rnd.randint(0, 6)) if rnd.random() < 0.7 else "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 70)))
        assert brands.similarity(a, b) == score(a, b)


def test_first_word_finds_the_same_alias_as_brute_force(spark):
    rnd = random.Random(9)
    aliases = {"".join(rnd.choice("abcde") for _ in range(rnd.choice([2, 4, 5, 6, 9, 11, 14, 17, 20, 21, 22, 25, 31]))) for _ in range(160)}
    words = [edited(rnd, rnd.choice(sorted(aliases)), rnd.randint(0, 5)) for _ in range(300)] + ["", "zzzz"]
    words = [w for w in words if " " not in w]
    titles = spark.createDataFrame([(w + " rest of title",) for w in words], "title string")
    table = spark.createDataFrame([(a, a.upper()) for a in aliases], "alias string, brand_group string")
    got = {r.word: r.alias for r in brands.first_word_matches(titles, table).collect()}
    want = {}
    for w in set(words):
        ranked = sorted((-score(w, a), -len(a), a) for a in aliases if w and score(w, a) >= 90)
        if ranked:
            want[w] = ranked[0][2]
    assert got == want
    assert any(len(w) > 21 for w in want) and any(len(w) < 15 for w in want)


def test_guess_prefers_first_word_then_longest_contained(spark):
    lines = spark.createDataFrame(
        [(1, "Sony, Sony Ericsson"), (2, 'Acme,"Acme, Inc"'), (3, "Café Noir,cafe noir"), (4, " ,ghost"), (5, "Other,Acme")], "line_no int, value string")
    aliases = brands.alias_table(lines)
    table = {r.alias: r.brand_group for r in aliases.collect()}
    assert table == {"Sony": "Sony", "Sony Ericsson": "Sony", "Acme": "Other", "Acme, Inc": "Acme", "Café Noir": "Café Noir", "cafe noir": "Café Noir", "Other": "Other"}
    titles = spark.createDataFrame([("Othher phone",), ("new inc tool by acme",), ("no brand here",), ("ericsson",), ("!!!",), (None,), ("new inc tool by acme",)], "title string")
    got = sorted(((r.title or "-"), r.brand) for r in brands.guess_brands(titles, aliases).collect())
    assert got == [("!!!", None), ("-", None), ("Othher phone", "Other"), ("ericsson", "Sony"), ("new inc tool by acme", "Acme"), ("new inc tool by acme", "Acme"), ("no brand here", None)]


def test_brand_file_order_decides(spark, tmp_path):
    (tmp_path / "brands.csv").write_text("One,x\nTwo,x\n")
    table = brands.alias_table(brands.read_brand_lines(spark, str(tmp_path)))
    assert {r.alias: r.brand_group for r in table.collect()} == {"One": "One", "Two": "Two", "x": "Two"}


def test_sorted_brands_ignore_case(spark):
    one = spark.createDataFrame([("b",), ("A",), ("C",), ("a",)], "brand string")
    assert [r.brand for r in brands.sorted_brands(one, one).collect()] == ["A", "a", "b", "C"]


def test_csv_cells(spark):
    row = spark.createDataFrame([('a ,"b, ""c""" ,, "d',)], "v string").select(brands.csv_cells(F.col("v")).alias("c")).first()
    assert row.c == ["a", 'b, "c"', "", '"d']


def test_a_very_long_first_word_is_cheap(spark):
    import time

    titles = spark.createDataFrame([("x" * 2000,), ("abcdefghijklmnopqrstuvwxyz ring",)], "title string")
    aliases = spark.createDataFrame([("abcdefghijklmnopqrstuvwxyy", "g"), ("short", "s")], "alias string, brand_group string")
    start = time.perf_counter()
    got = {r.word[:5]: r.alias for r in brands.first_word_matches(titles, aliases).collect()}
    assert got == {"abcde": "abcdefghijklmnopqrstuvwxyy"} and time.perf_counter() - start < 30


def test_only_items_with_a_title_and_no_brand_get_a_guess(spark):
    aliases = spark.createDataFrame([("acme", "Acme"), ("zenith", "Zenith")], "alias string, brand_group string")
    rows = [(1, "Acme kettle", None), (2, "Acme kettle", ""), (3, "Acme kettle", "Own"), (4, None, None), (5, "", None), (6, "nothing known", None), (7, "Super zenith tv", None), (7, "Super zenith tv", None)]
    got = brands.fill_brands(spark.createDataFrame(rows, "id int, title string, brand string"), aliases).collect()
    assert sorted((r.id, r.title, r.brand) for r in got if r.title) == [
        (1, "Acme kettle", "Acme"), (2, "Acme kettle", "Acme"), (3, "Acme kettle", "Own"), (6, "nothing known", None), (7, "Super zenith tv", "Zenith"), (7, "Super zenith tv", "Zenith")]
    assert sorted((r.id, r.title, r.brand) for r in got if not r.title) == [(4, None, None), (5, "", None)]


def contained(titles, aliases):
    """Longest alias whose words are a subset or a superset of the title's, by looking at all."""
    out = {}
    for title in titles:
        words = set(title.split())
        fits = [a for a in aliases if words and (set(a.split()) <= words or words <= set(a.split()))]
        if fits:
            out[" ".join(sorted(words))] = min(fits, key=lambda a: (-len(a), a))
    return out


@pytest.mark.parametrize("hot", [0, 3, 50, 10_000])
def test_containment_with_hot_words_equals_brute_force(spark, hot):
    """A third of titles and aliases share a word, many share two; hot words meet in pairs."""
    rnd = random.Random(hot)
    rare = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(w for w, p in (("the", 0.4), ("of", 0.3), ("new", 0.2)) if rnd.random() < p) + " " + " ".join(rnd.choices(rare, k=rnd.randrange(n)))
    titles = sorted({draw(5).strip() for _ in range(500)} | {"the", "of the", "new of the"})
    aliases = sorted({draw(3).strip() for _ in range(150)} | {"of new", "the of new"} - {""})
    got = brands.contained_matches(spark.createDataFrame([(t,) for t in titles], "title string"), spark.createDataFrame([(a, "g") for a in aliases if a], "alias string, brand_group string"), hot)
    assert {r.title_key: r.alias for r in got.collect()} == contained(titles, [a for a in aliases if a])


def test_pairs_of_hot_words_bound_what_meets(spark):
    """Every title and alias has two of forty hot words: at single words 400 times as many pairs would meet as match."""
    hot = [f"h{i:02}" for i in range(40)]
    both = [(a, b) for i, a in enumerate(hot) for b in hot[i + 1:]]
    titles = spark.createDataFrame([(f"{a} {b} t{i}",) for i, (a, b) in enumerate(both)], "title string")
    aliases = spark.createDataFrame([(f"{a} {b}", "g") for a, b in both], "alias string, brand_group string")
    words = lambda df, c: df.select(c, F.split(c, " ").alias("w"))
    found = brands._inside(words(aliases, "alias"), "alias", "w", words(titles, "title").withColumnRenamed("w", "o"), "title", "o", 10)
    assert found.count() == len(both)
    plan = found._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.toString() else plan
    joined = []

    def walk(node):
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            joined.append(node.metrics().get("numOutputRows").get().value())
        for source in (node.children(), *([node.plan().children()] if hasattr(node, "plan") and "Stage" in node.nodeName() else [])):
            for i in range(source.size()):
                walk(source.apply(i))

    walk(plan)
    assert max(joined, default=0) <= 4 * len(both)


def test_long_words_over_tiers_equal_brute_force(spark):
    rnd = random.Random(21)
    aliases = {"".join(rnd.choice("abcdefgh") for _ in range(n)) for n in range(17, 90) for _ in range(3)}
    words = [edited(rnd, rnd.choice(sorted(aliases)), rnd.randint(0, 9)) for _ in range(250)]
    titles = spark.createDataFrame([(w,) for w in words], "title string")
    got = {r.word: r.alias for r in brands.first_word_matches(titles, spark.createDataFrame([(a, "g") for a in aliases], "alias string, brand_group string")).collect()}
    want = {}
    for w in set(words):
        ranked = sorted((-score(w, a), -len(a), a) for a in aliases if abs(len(a) - len(w)) < 30 and score(w, a) >= 90)
        if ranked:
            want[w] = ranked[0][2]
    assert got == want and len(want) > 150
