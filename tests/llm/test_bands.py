import re
from collections import Counter

import zstandard

from shelfspark.llm import bands, queries
from tests.llm.conftest import EDGE, SF_DIR, prose, same


def brute(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update((i, i + 1, i + 2))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return doc_id, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_counts_match_brute_force(spark, edge, small):
    for got, rows in ((bands.quality_rules(edge), EDGE), (queries.op7_quality_rules(spark, SF_DIR), small[1])):
        found = got.collect()
        same([tuple(r)[:7] for r in found], [brute(*r) for r in rows])
        assert all(r.kept == (not r.base_failed and r.in_band) for r in found)


def test_bands():
    press = zstandard.ZstdCompressor(level=3)
    noise = bytes(range(256)) * 0 + __import__("random").Random(0).randbytes(6000)
    assert bands.in_band(prose(1, 2000).encode(), press)
    assert not bands.in_band(noise, press)
    assert not bands.in_band(b"spam spam " * 500, press)
    assert bands.in_band(b"short", press) and bands.in_band(b"", press)
    half_bad = prose(2, 700).encode()[:4096] + b"spam eggs " * 4000
    assert not bands.in_band(half_bad, press)


def test_clean_driver_documents_stay(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1")
    rows = queries.op7_quality_rules(spark, SF_DIR).join(labels, "doc_id").collect()
    assert rows and all(r.in_band for r in rows)


def test_empty(empty):
    assert bands.quality_rules(empty).collect() == []


def test_noise_of_printable_characters_is_out_of_band():
    import base64
    import random
    import string

    r, press = random.Random(4), zstandard.ZstdCompressor(level=3)
    words = lambda n: " ".join("".join(r.choices(string.ascii_letters + string.digits, k=r.randint(3, 10))) for _ in range(n // 6))[:n].encode()
    for n in (600, 1000, 1900, 4000, 4096, 20_000, 100_000):
        assert not bands.in_band(base64.encodebytes(r.randbytes(n))[:n], press), n
        assert not bands.in_band(words(n), press), n
    assert not bands.in_band(r.randbytes(6000).hex().encode(), press)
    clean = prose(5, 6000).encode()
    for n in (8192, 16_384, 32_768):
        assert bands.in_band(clean[:n], press)
        assert not bands.in_band(clean[: n // 2] + base64.encodebytes(r.randbytes(n))[: n // 2], press), n
    # Of ten chunks, three are noise: more than a quarter, though the whole is within its band.
    some = clean[: 7 * 4096] + base64.encodebytes(r.randbytes(3 * 4096))[: 3 * 4096]
    whole = ((1 << 62, 0.2, 0.9),)
    assert not bands.in_band(some, press, whole) and bands.in_band(some, press, whole, max_bad=0.5)


def test_dump_in_lines_and_random_words_are_not_kept(spark):
    import base64
    import random

    r = random.Random(5)
    rows = [(1, base64.encodebytes(r.randbytes(6000)).decode()), (2, " ".join(r.randbytes(5).hex()[:9].upper() + "xQz"[i % 3] for i in range(400))), (3, prose(6, 900))]
    kept = {r.doc_id: (r.base_failed, r.kept) for r in bands.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert kept == {1: (False, False), 2: (False, False), 3: (False, True)}
