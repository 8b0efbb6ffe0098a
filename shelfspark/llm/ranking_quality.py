"""Quality scores learnt from preferences: a Bradley-Terry model on features of the text.

Each training pair is a document marked good and one marked bad. The chance that the good one is preferred is the logistic
function of the difference of their scores, and a score is linear in the text's features, so the loss is logistic on feature
differences. Features are shares and ratios, each turned into one indicator per quantile bin of the training rows, so a score
may rise and fall along a feature. The threshold is the score quantile of the training rows at the share of bad ones.

All labelled rows train: quantiles are sketches over all of them, each row is in a pair, and every Newton step sums over all pairs.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.bands import repeated_words
from shelfspark.llm.common import id_type, map_rows, stored, texts_of
from shelfspark.operators.groups import numbered

FEATURES = (
    "log_words", "word_length", "distinct_share", "top_share", "repeat_share", "symbol_share", "shout_share", "pipe_share",
    "capital_share", "digit_share", "mark_share", "line_share", "foreign_share", "ratio", "least_ratio", "top_symbols",
)
CAPITALS, SMALL, DIGITS = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
SYMBOLS = b"#*$%&<>^~{}[]=_\\"
MARKS = b".,;:?"
PART = 4096


def features(text: str, press) -> list[float]:
    """Numbers that describe how a text is written; none of them names a word, a language or a source."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)

    def count(chars: bytes, of: bytes = raw) -> int:
        return len(of) - len(of.translate(None, chars))

    capitals, small = count(CAPITALS), count(SMALL)
    seen = Counter(words)
    parts = [raw[i : i + PART] for i in range(0, max(1, size - PART // 2), PART)]
    return [
        math.log1p(n), sum(map(len, words)) / n, len(seen) / n, seen.most_common(1)[0][1] / n, repeated_words(words) / n,
        count(SYMBOLS) / size, raw.count(b"!") / size, raw.count(b"|") / size, capitals / (capitals + small + 1),
        count(DIGITS) / size, count(MARKS) / n, raw.count(b"\n") / n, 1 - len(text) / size,
        len(press.compress(raw)) / size, min(len(press.compress(p)) / len(p) for p in parts), max(count(SYMBOLS + b"!|", p) / len(p) for p in parts),
    ]


def text_features(docs: DataFrame) -> DataFrame:
    def rows(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield {"doc_id": b["doc_id"], "features": [features(t, press) for t in b["text"]]}

    return map_rows(texts_of(docs), rows, f"doc_id {id_type(docs)}, features array<double>", batch=500)


def held_out(doc_id: Column) -> Column:
    """One in five ids, by checksum; these never train."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass
class Model:
    cuts: np.ndarray  # features x (bins - 1)
    weights: np.ndarray  # features x bins
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for k in range(x.shape[1]):
            total += self.weights[k][np.searchsorted(self.cuts[k], x[:, k], "right")]
        return total

    def score(self, x: np.ndarray, at: float) -> np.ndarray:
        """Logistic in the raw score, with ``at`` at the threshold."""
        z = np.clip(self.raw(x) - self.threshold + math.log(at / (1 - at)), -60, 60)
        return 1 / (1 + np.exp(-z))


def cut_points(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Half the cuts from each kind, so that the rarer one is told apart as finely; both are features x quantiles."""
    return np.sort(np.concatenate([good[:, ::2], bad[:, 1::2]], axis=1), axis=1)


def shares(bins: int) -> np.ndarray:
    return np.arange(1, bins) / bins


def bin_numbers(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, f], "right") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def rounds(larger: int, lesser: int, pairs: int) -> int:
    """How many rows of the lesser kind each row of the larger one meets: one at least, and enough for ``pairs`` where there are as many."""
    return min(lesser, max(1, -(-pairs // larger)))


def pair_sums(a: np.ndarray, b: np.ndarray, w: np.ndarray, bins: int) -> np.ndarray:
    """Gradient, and below it the Hessian, of the logistic loss over pairs of bin numbers, the better row's and the worse one's."""
    at = np.arange(a.shape[1]) * bins
    out = np.zeros((len(w) + 1, len(w)))
    for i in range(0, len(a), 4096):
        # A row has one bin of each feature, so no place of ``d`` is met twice by either side.
        better, worse = a[i : i + 4096] + at, b[i : i + 4096] + at
        d, rows = np.zeros((len(better), len(w))), np.arange(len(better))[:, None]
        d[rows, better] += 1.0
        d[rows, worse] -= 1.0
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        out[0] += d.T @ (1 - p)
        out[1:] += (d * (p * (1 - p))[:, None]).T @ d
    return out


def newton(sums: Callable[[np.ndarray], np.ndarray], size: int, ridge: float) -> np.ndarray:
    """Weights of least ridged loss; ``sums`` gives the ``pair_sums`` over all pairs."""
    w = np.zeros(size)
    for _ in range(12):
        found = sums(w)
        step = np.linalg.solve(found[1:] + ridge * np.eye(size), found[0] - ridge * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, bins: int = 12, pairs: int = 60_000, ridge: float = 2.0) -> Model:
    """The model of rows in memory, by the rules of ``train``.

    Without rows of both kinds there is nothing to learn: all scores are then equal and lie above the threshold.
    """
    n, k = x.shape
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return Model(np.zeros((k, bins - 1)), np.zeros((k, bins)), -1.0)
    cuts = cut_points(*(np.quantile(x[rows], shares(bins), axis=0).T for rows in (better, worse)))
    place, (less, more) = bin_numbers(x, cuts), sorted((better, worse), key=len)
    i = np.arange(len(more) * rounds(len(more), len(less), pairs))
    met = more[i % len(more)], less[(i % len(more) + i // len(more)) % len(less)]
    a, b = met if more is better else met[::-1]
    model = Model(cuts, newton(lambda w: pair_sums(place[a], place[b], w, bins), k * bins, ridge).reshape(k, bins), 0.0)
    model.threshold = float(np.quantile(model.raw(x), len(worse) / n))
    return model


def feature_rows(found: pa.Array) -> np.ndarray:
    return np.asarray(found.flatten(), dtype=np.float64).reshape(-1, len(FEATURES))


def _summed(pairs: DataFrame, w: np.ndarray, bins: int, last: int = 16) -> np.ndarray:
    """``pair_sums`` over the stored ``pairs``: a sum for each task, then ``last`` sums of those, which the driver adds up."""
    shape = (len(w) + 1, len(w))

    def bins_of(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)

    def row(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    def one(batches):
        total = np.zeros(shape)
        for b in batches:
            total += pair_sums(bins_of(b["better"]), bins_of(b["worse"]), w, bins)
        yield row(total)

    def added(batches):
        total = np.zeros(shape)
        for b in batches:
            for v in b["sums"]:
                total += np.frombuffer(v.as_py()).reshape(shape)
        yield row(total)

    parts = pairs.mapInArrow(one, "sums binary").repartition(last).mapInArrow(added, "sums binary")
    return sum(np.frombuffer(r.sums).reshape(shape) for r in parts.collect())


def train(described: DataFrame, labels: DataFrame, bins: int = 12, pairs: int = 60_000, ridge: float = 2.0) -> Model:
    """Fit on all labelled rows of ``described`` that are not held out.

    Cuts and threshold are quantiles over all these rows, by sketches that are off by 0.1 and 0.01 % of the ranks at most. Each row of
    the larger kind, in order of a hash of its id, meets the next ones of the lesser kind, which is gone through again and again, so
    that every row is in a pair; ``pairs`` is the least number of pairs where there are as many. Only sums over pairs reach the driver.
    """
    k = len(FEATURES)
    marks = labels.where("quality in (0, 1)").select("doc_id", "quality").where(~held_out(F.col("doc_id")))
    rows = described.join(marks, "doc_id").select("features", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id").alias("_order"))
    rows = stored(rows, "labelled")
    at = F.array(*[F.lit(float(v)) for v in shares(bins)])
    found = rows.groupBy("quality").agg(F.count("*").alias("n"), *[F.percentile_approx(F.col("features")[f], at, 1000).alias(f"_f{f}") for f in range(k)])
    facts = {r.quality: (r.n, np.array([r[f"_f{f}"] for f in range(k)])) for r in found.collect()}
    if len(facts) < 2:
        return Model(np.zeros((k, bins - 1)), np.zeros((k, bins)), -1.0)
    cuts = cut_points(facts[1][1], facts[0][1])
    more, less = sorted((1, 0), key=lambda q: -facts[q][0])
    n, n_less = facts[more][0], facts[less][0]

    @F.arrow_udf("binary")
    def binned(x: pa.Array) -> pa.Array:
        place = np.ascontiguousarray(bin_numbers(feature_rows(x), cuts))
        return pa.Array.from_buffers(pa.binary(k), len(place), [None, pa.py_buffer(place)]).cast(pa.binary())

    places = numbered(rows.select("quality", "_order", binned("features").alias("bins")), ["quality"], ["_order", "bins"])
    places = stored(places.select("quality", "bins", "pos"), "places")
    sides = {q: places.where(F.col("quality") == q) for q in (more, less)}
    turns = F.explode(F.sequence(F.lit(0), F.lit(rounds(n, n_less, pairs) - 1)))
    first = sides[more].select(F.col("bins").alias("_first"), "pos", turns.alias("_turn")).withColumn("_meets", (F.col("pos") + F.col("_turn")) % n_less)
    second = sides[less].select(F.col("bins").alias("_second"), F.col("pos").alias("_meets"))
    better, worse = ("_first", "_second") if more == 1 else ("_second", "_first")
    met = stored(first.join(second, "_meets").select(F.col(better).alias("better"), F.col(worse).alias("worse")), "pairs")

    weights = newton(lambda w: _summed(met, w, bins), k * bins, ridge).reshape(k, bins)
    model = Model(cuts, weights, 0.0)

    @F.arrow_udf("double")
    def raw(x: pa.Array) -> pa.Array:
        return pa.array(model.raw(feature_rows(x)))

    share = facts[0][0] / (facts[0][0] + facts[1][0])
    threshold = rows.agg(F.percentile_approx(raw("features"), F.lit(share), 10_000)).first()[0]
    return Model(cuts, weights, float(threshold))


def quality_scores(docs: DataFrame, labels: DataFrame, at: float = 0.3, field: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``; ``predicted`` is 1 from a score of ``at`` on.

    The model trains on all labelled rows that are not held out. Null and
    empty texts are scored as texts without words. Repeated rows score alike; labels without document, with null or other
    values are ignored; a null id is held out. If ``doc_id`` is a struct, ``field`` names the part that labels know.
    """
    described = stored(text_features(docs), "features")
    own = F.col("doc_id") if field is None else F.col("doc_id").getField(field)
    model = train(described.withColumn("doc_id", own), labels)

    @F.arrow_udf("double")
    def score(found: pa.Array) -> pa.Array:
        return pa.array(model.score(feature_rows(found), at))

    scored = described.select("doc_id", held_out(own).alias("held_out"), score("features").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= at).cast("int"))
