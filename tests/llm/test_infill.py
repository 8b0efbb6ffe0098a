"""Fill-in-middle against a row-by-row version, and its way back."""

import hashlib
import random
import re

import pyarrow as pa

from shelfspark.llm import infill, queries
from tests.llm.conftest import EDGE, SF_DIR, same

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
ODD = [
    (20, "a <P> mark"), (21, "<S>"), (22, "<<M> x"), (23, "\x00\x01 b \x00\x01\x01 c\x00"), (24, "  lead and trail \n\t"), (25, "< S> <P <M"),
    (26, "nul\x00 \x01\x01\x01"), (27, "\x1c\x85  no breaks here"), (28, "<"), (29, "a<\x0bP>")]


def expected(doc_id, text, seed=42, plain=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_awkward_documents(spark, edge):
    extra = spark.createDataFrame(ODD, "doc_id bigint, text string")
    docs = edge.unionByName(extra, allowMissingColumns=True)
    for shares in ((50, 80), (0, 50), (0, 0), (0, 100), (100, 80)):
        made = infill.restored(infill.fill_in_middle(docs, 42, *shares)).collect()
        same([r[:-1] for r in made], [expected(d, t, 42, *shares) for d, t in EDGE + ODD])
        same([(r.doc_id, r.restored) for r in made], [(d, t or "") for d, t in EDGE + ODD])


def test_empty_table(empty):
    assert infill.restored(infill.fill_in_middle(empty)).collect() == []


def test_query(spark, small):
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(*r[:-1], digest(r[-1]), digest(t or "")) for (_, t), r in ((d, expected(*d)) for d in small[1])]
    same(queries.op13_fill_in_middle(spark, SF_DIR).collect(), want)


def test_separator_is_new():
    r = random.Random(1)
    texts = ["".join(r.choice("\x00\x01a") for _ in range(200)) for _ in range(50)]
    mark = infill.separator(pa.array(texts))
    assert all(mark not in t for t in texts)
    for a, b in zip(texts, texts[1:]):
        assert (a + mark + b).split(mark) == [a, b]
