"""Quality scores learned from preferences: Bradley-Terry pairwise ranking with a quantile threshold.

A document is described by `FEATURES`: shares of kinds of bytes, of repeated words and lines, and lengths. A document
labelled good is preferred to one labelled bad, and in the Bradley-Terry model the chance of a preference is
sigmoid(s(good) - s(bad)). With s(x) = w.x this is the logistic loss on feature differences; its ridge-penalised
minimum is found by Newton steps in numpy. All labelled training documents are then scored, and the threshold is the
quantile of their scores at the share of bad ones among them. The published score is sigmoid(s - threshold) shifted so
that a document at the threshold gets `CUT`.

Bounds: the pairs come from at most `PER_LABEL` distinct texts of either label (by hash), each meeting `RIVALS` of the
other label; that bounds what fits the weights and nothing else. The threshold comes from all labelled training rows,
by a histogram of `BINS` fixed-width bins of the score, which is also what reaches the driver. Every document is described
in one pass without a shuffle; what is joined with the labels and scored are the descriptions, never the texts. Rows whose crc32(doc_id) leaves 0 modulo `HOLD_OUT` never teach anything.

Edge cases: a null text is empty and has a score like any other. A doc_id with both labels, a null label or a null
doc_id teaches nothing; several rows of a labelled document each count in the threshold. Without a preference (one
label missing, empty tables) every score is 1/2. Repeated rows are scored alike, each on its own row. Very long texts
are read whole, one at a time. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from slowtide.llm.common import chunks, pick, sums, text_bytes
from slowtide.llm.language import held_out
from slowtide.session import materialize, ship

PER_LABEL = 3_000
RIVALS = 8
RIDGE = 1e-3
STEPS = 50
CUT = 0.3
#: Scores are counted in bins of this width, from -BINS / 2 to BINS / 2 widths.
BIN = 1 / 64
BINS = 1 << 14
CHUNK = 4 << 20

FEATURES = ("words", "symbols", "upper", "digits", "stops", "other_bytes", "letters", "distinct", "same_neighbour", "repeated_lines", "word_length", "line_words")
_KINDS = {
    "symbols": b"#*$%&|<>", "upper": bytes(range(65, 91)), "digits": bytes(range(48, 58)), "stops": b".!?", "other_bytes": bytes(range(128, 256)), "letters": bytes(range(97, 123)),
}


@dataclass(frozen=True)
class Ranker:
    """score(x) = weights . (x - centre) / scale; `threshold` is a quantile of the training scores."""

    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), 0.5)
        return sigmoid(self.raw(x) - self.threshold + np.log(CUT / (1 - CUT)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of `FEATURES` for each text; `data` and `offsets` are the UTF-8 bytes end to end."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    size = np.maximum(np.diff(offsets), 1)
    for name, of in _KINDS.items():
        member = np.zeros(256, bool)
        member[list(of)] = True
        out[:, FEATURES.index(name)] = np.sqrt(sums(member[data], offsets) / size)
    whole, at = data.tobytes(), offsets.tolist()
    tail = np.zeros((n, 6))
    for i in range(n):
        text = whole[at[i] : at[i + 1]]
        words = text.split()
        if not words:
            continue
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        same = sum(map(bytes.__eq__, words[1:], words[:-1]))
        many = len(words)
        tail[i] = np.log1p(many), len(set(words)) / many, np.sqrt(same / many), np.sqrt(1 - len(set(lines)) / len(lines)), np.log(sum(map(len, words)) / many), np.log1p(many / len(lines))
    out[:, [FEATURES.index(x) for x in ("words", "distinct", "same_neighbour", "repeated_lines", "word_length", "line_words")]] = tail
    return out


def bradley_terry(good: np.ndarray, bad: np.ndarray, rivals: int = RIVALS, ridge: float = RIDGE) -> np.ndarray:
    """Weights under which rows of `good` beat rows of `bad`; each row of the longer side meets `rivals` of the other.

    Newton steps on mean(log(1 + exp(-w.d))) + ridge |w|^2 / 2 over the differences d, halved while the loss rises.
    """
    n = max(len(good), len(bad))
    turn = np.arange(n)
    diffs = np.concatenate([good[turn % len(good)] - bad[(turn + k * (1 + len(bad) // rivals)) % len(bad)] for k in range(min(rivals, max(len(good), len(bad))))])
    w = np.zeros(good.shape[1])
    loss = lambda v: np.logaddexp(0, -(diffs @ v)).mean() + ridge * (v @ v) / 2
    now = loss(w)
    for _ in range(STEPS):
        p = sigmoid(-(diffs @ w))
        slope = -(diffs.T @ p) / len(diffs) + ridge * w
        bend = (diffs * (p * (1 - p))[:, None]).T @ diffs / len(diffs) + ridge * np.eye(len(w))
        step, share = np.linalg.solve(bend, slope), 1.0
        while (then := loss(w - share * step)) > now and share > 1e-6:
            share /= 2
        w = w - share * step
        if now - then < 1e-12:
            break
        now = then
    return w


def describe(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, with the features `x` of the whole text, of every document, in one pass without a shuffle."""
    ship(docs.sparkSession)
    source = docs.select(*dict.fromkeys([*keep, text]))
    out = StructType([*source.select(*keep).schema, StructField("x", ArrayType(DoubleType()))])
    kept = list(keep)

    def described(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            for a, b in chunks(offsets, CHUNK):
                x = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(a, b - a) for k in kept], pa.array(list(x), pa.list_(pa.float64()))], names=[*kept, "x"])

    return source.mapInArrow(described, out)


def _labelled(described: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, good) of the documents outside the hold-out that have one label; texts are not needed any more."""
    one = pick(labels, "doc_id", "quality").filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"), F.count_if(F.col("quality").isNull()).alias("none"))
    told = one.filter("low = high and low in (0, 1) and none = 0").filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("labelled_id"), (F.col("low") == 1).alias("good"))
    return described.select("doc_id", "x").join(told, F.col("doc_id") == F.col("labelled_id")).select("x", "good")


def fit(described: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Ranker:
    """Learn from described documents: weights from preference pairs of a bounded sample, the threshold from all labelled training rows."""
    width = len(FEATURES)
    rows = materialize(_labelled(described, labels), "labelled")
    # copies of one text have one row of features; the hash puts the labels' rows in an order of their own
    code = F.xxhash64("x")
    sampled = []
    for good in (True, False):
        own = rows.filter(F.col("good") == good).groupBy("x").agg(F.lit(1))
        sampled.append(own.select("x").orderBy(code, "x").limit(per_label).toPandas()["x"])
    if not len(sampled[0]) or not len(sampled[1]):
        return Ranker(np.zeros(0), np.zeros(width), np.ones(width), 0.0)
    good, bad = (np.array(list(s)) for s in sampled)
    both = np.concatenate([good, bad])
    centre, scale = both.mean(axis=0), both.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    weights = bradley_terry((good - centre) / scale, (bad - centre) / scale)
    ranker = Ranker(weights, centre, scale, 0.0)

    def binned(batches):
        """Rows of each bin, one record a task and bin, good ones apart."""
        counts = np.zeros((2, BINS), np.int64)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, width)
            at = np.clip(np.floor(ranker.raw(x) / BIN).astype(np.int64) + BINS // 2, 0, BINS - 1)
            np.add.at(counts, (batch.column("good").to_numpy(zero_copy_only=False).astype(int), at), 1)
        label, at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(label == 1), pa.array(at.astype(np.int32)), pa.array(counts[label, at])], names=["good", "bin", "n"])

    found = rows.mapInArrow(binned, "good boolean, bin int, n long").groupBy("good", "bin").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, BINS), np.int64)
    counts[found["good"].astype(int), found["bin"]] = found["n"]
    return Ranker(weights, centre, scale, quantile(counts.sum(axis=0), int(counts[0].sum())))


def quantile(counts: np.ndarray, rejected: int) -> float:
    """The score below which `rejected` of the counted rows lie; the middle of the gap if the bins there are empty."""
    upto = np.cumsum(counts)
    at = int(np.searchsorted(upto, rejected))
    if upto[at] > rejected:
        return (at - BINS // 2) * BIN
    after = int(np.searchsorted(upto, rejected, side="right"))
    return ((at + 1 + min(after, BINS - 1)) / 2 - BINS // 2) * BIN


def rank(described: DataFrame, ranker: Ranker) -> DataFrame:
    """The columns of the described documents, with score and predicted in place of `x`."""
    kept = [c for c in described.columns if c != "x"]
    out = StructType([*described.select(*kept).schema, StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def rows(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            score = ranker.score(x)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], pa.array(score), pa.array((score >= CUT).astype(np.int32))], names=[*kept, "score", "predicted"])

    return described.select(*kept, "x").mapInArrow(rows, out)


def op11_pairwise_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    described = materialize(describe(pick(docs, "doc_id", "text")), "described")
    found = rank(described, fit(described, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
