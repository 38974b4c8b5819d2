"""Language identification with a byte convolutional network.

A text's UTF-8 bytes are folded to `CLASSES` classes and cut into windows of `LENGTH` bytes that overlap by
the widest filter less one, so every gram of the text lies in some window. Each window passes filters of
several widths, max pooling and a softmax; a text's distribution is the mean over its windows. The network is
trained in numpy (Adam, seeded) on windows of labelled texts.

Bounds: training sees at most `PER_LANGUAGE` documents of a language, `SAMPLE` in all, and `WINDOWS` windows
of one row of each id, spread evenly over the text; documents whose crc32(doc_id) leaves 0 modulo `HOLD_OUT` are never
seen. Prediction covers every byte of every text, in one pass without a shuffle.

Edge cases: a null text, or one without a letter, gets `und` with score 0; an empty training set makes all
texts `und`. A null doc_id counts as the empty string for the hold-out. Ties go to the first language in
alphabetical order. Repeated rows are predicted alike, each on its own row. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.llm.common import chunks, pick, text_bytes
from slowtide.session import ship

UNKNOWN = "und"
HOLD_OUT = 5
PER_LANGUAGE = 400
SAMPLE = 2_000
SHARES = 64
WINDOWS = 8
LENGTH = 128
WIDTHS = (2, 3, 4)
STRIDE = LENGTH - max(WIDTHS) + 1
FILTERS = 16
EPOCHS = 8
BATCH = 128
RATE = 0.01
#: Bytes and windows worked on at once.
CHUNK = 1 << 20
BLOCK = 1024

#: 0 padding, 1 any other ASCII, 2..27 letters without case, 28.. the bytes of longer code points.
CLASSES = 28 + 128
_CLASS = np.ones(256, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = np.arange(2, 28)
_CLASS[128:] = np.arange(28, 156)


@dataclass
class Network:
    """`taps[w][j, class, filter]`, a bias per filter, and the softmax layer."""

    languages: list[str]
    taps: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HOLD_OUT == 0


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes by (place in the window, window), and the number of windows of each text (at least one)."""
    lengths = np.diff(offsets)
    count = np.maximum(1, -(-(lengths - (LENGTH - STRIDE)) // STRIDE))
    first = np.cumsum(count) - count
    inner = np.arange(count.sum()) - np.repeat(first, count)
    start = np.repeat(offsets[:-1], count) + inner * STRIDE
    left = np.repeat(offsets[1:], count) - start
    padded = np.concatenate([_CLASS[data], np.zeros(LENGTH, np.uint8)])
    place = np.arange(LENGTH)[:, None]
    return np.where(place < left, padded[start + place], 0), count


def _logits(network: Network, pooled: np.ndarray) -> np.ndarray:
    return np.maximum(pooled + network.bias, 0) @ network.dense + network.offset


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(languages: list[str], cut: np.ndarray, wanted: np.ndarray, seed: int = 7) -> Network:
    """Fit on windows `cut` (place, window) with language numbers `wanted`."""
    rng = np.random.default_rng(seed)
    wide = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        {w: rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS},
        np.zeros(wide, np.float32),
        rng.normal(0, 0.3, (wide, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    weights = [*net.taps.values(), net.bias, net.dense, net.offset]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in weights]
    # every language counts the same
    share = 1 / np.maximum(np.bincount(wanted, minlength=len(languages)), 1)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(wanted))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, y = cut[:, rows], wanted[rows]
            pooled, tops = [], []
            for w in WIDTHS:
                seen = sum(net.taps[w][j][x[j : LENGTH - w + 1 + j]] for j in range(w))
                top = seen.argmax(axis=0)
                tops.append(top)
                pooled.append(np.take_along_axis(seen, top[None], axis=0)[0])
            flat = np.concatenate(pooled, axis=1)
            active = np.maximum(flat + net.bias, 0)
            error = _softmax(active @ net.dense + net.offset)
            error[np.arange(len(y)), y] -= 1
            weight = share[y]
            error *= (weight / weight.sum())[:, None]
            back = (error @ net.dense.T) * (active > 0)
            grads = []
            for k, w in enumerate(WIDTHS):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                slots = np.arange(FILTERS)[None, :]
                grads.append(
                    np.stack(
                        [
                            np.bincount((x[tops[k] + j, np.arange(len(rows))[:, None]].astype(np.int64) * FILTERS + slots).ravel(), part.ravel(), CLASSES * FILTERS).reshape(CLASSES, FILTERS)
                            for j in range(w)
                        ]
                    )
                )
            grads += [back.sum(axis=0), active.T @ error, error.sum(axis=0)]
            step += 1
            for p, g, (m, v) in zip(weights, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def tables(net: Network) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Filters summed by pairs of classes, so that a gram needs at most two look-ups."""
    out = []
    for w in WIDTHS:
        t = net.taps[w]
        head = (t[0][:, None] + t[1][None]).reshape(CLASSES * CLASSES, FILTERS)
        tail = None if w == 2 else t[2] if w == 3 else (t[2][:, None] + t[3][None]).reshape(CLASSES * CLASSES, FILTERS)
        out.append((head, tail))
    return out


def probabilities(net: Network, summed: list, cut: np.ndarray) -> np.ndarray:
    """Distribution over the languages of each window."""
    out = np.empty((cut.shape[1], len(net.languages)))
    for a in range(0, cut.shape[1], BLOCK):
        x = cut[:, a : a + BLOCK]
        pair = x[:-1].astype(np.int32) * CLASSES + x[1:]
        pooled = []
        for w, (head, tail) in zip(WIDTHS, summed, strict=True):
            seen = head.take(pair[: LENGTH - w + 1], axis=0)
            if w == 3:
                seen += tail.take(x[2:], axis=0)
            elif w == 4:
                seen += tail.take(pair[2:], axis=0)
            pooled.append(seen.max(axis=0))
        out[a : a + BLOCK] = _softmax(_logits(net, np.concatenate(pooled, axis=1)).astype(np.float64))
    return out


def fit(docs: DataFrame) -> Network:
    """Train on a bounded sample of the labelled texts outside the hold-out."""
    ship(docs.sparkSession)
    source = pick(docs, "doc_id", "text", "lang").filter("doc_id is not null and text is not null and lang is not null")
    source = source.filter(~held_out(F.col("doc_id")))
    # first within shares of a language, so that what reaches one task is bounded however common the language is
    code = F.xxhash64("doc_id")
    by_hash = Window.partitionBy("lang", "share").orderBy(code, "doc_id")
    near = source.select("doc_id", "lang", F.pmod(F.shiftright(code, 20), F.lit(SHARES)).alias("share")).withColumn("turn", F.row_number().over(by_hash))
    in_language = Window.partitionBy("lang").orderBy(code, "doc_id")
    ranked = near.filter(F.col("turn") <= 4 * PER_LANGUAGE // SHARES).withColumn("turn", F.row_number().over(in_language)).filter(F.col("turn") <= PER_LANGUAGE)
    chosen = ranked.orderBy("turn", "lang", "doc_id").limit(SAMPLE).select("doc_id").distinct()

    def cuts(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            found, names = [], []
            for i in range(batch.num_rows):
                x, count = windows(data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
                some = np.unique(np.linspace(0, count[0] - 1, WINDOWS).astype(int))
                found += [w.tobytes() for w in np.ascontiguousarray(x[:, some].T)]
                names += [batch.column("lang")[i].as_py()] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())], names=["lang", "cut"])

    # one row of each id, whatever it is repeated; the filter on the number is applied before the shuffle, too
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "lang", "text")
    rows = source.join(F.broadcast(chosen), "doc_id", "left_semi").withColumn("turn", F.row_number().over(one)).filter("turn = 1")
    sample = rows.select("text", "lang").mapInArrow(cuts, "lang string, cut binary").toPandas()
    sample = sample.sort_values(["lang", "cut"], ignore_index=True)
    languages = sorted(sample["lang"].unique())
    if not languages:
        return Network([], {}, np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    cut = np.frombuffer(b"".join(sample["cut"]), np.uint8).reshape(len(sample), LENGTH).T
    return train(languages, np.ascontiguousarray(cut), np.searchsorted(languages, sample["lang"].to_numpy(object)))


def identify(docs: DataFrame, net: Network, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, with lang_pred and score, of every document."""
    ship(docs.sparkSession)
    source = docs.select(*dict.fromkeys([*keep, text]), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters__"))
    out = source.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    kept = list(keep)

    def rows(batches):
        summed = tables(net) if net.languages else []
        names = np.array(net.languages + [UNKNOWN], object)
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            letters = batch.column("letters__").to_numpy(zero_copy_only=False).astype(bool)
            for a, b in chunks(offsets, CHUNK):
                best, score = np.full(b - a, len(net.languages)), np.zeros(b - a)
                if net.languages:
                    cut, count = windows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    mean = np.add.reduceat(probabilities(net, summed, cut), np.cumsum(count) - count, axis=0) / count[:, None]
                    known = letters[a:b]
                    best[known], score[known] = mean[known].argmax(axis=1), np.minimum(mean[known].max(axis=1), 1.0)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(a, b - a) for k in kept], pa.array(names[best], pa.string()), pa.array(score)],
                    names=[*kept, "lang_pred", "score"],
                )

    return source.mapInArrow(rows, out)


def op2_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(pick(docs, "doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
