"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio.

Each text is cut into overlapping grams of `GRAM` bytes, each hashed to one of `BUCKETS` buckets. Two
multinomials over the buckets are counted: the raw corpus (every document) and the trusted target
(documents labelled good and not toxic). A document's score is the mean over its grams of
log(p_target / p_raw), held in fixed point so that sums are exact in any order. It is kept if the base rules
pass and the score is at least the threshold, which is the score that all but `LOST` of the trusted
documents reach.

Bounds: every document is counted and judged, and every trusted one fits the target and the threshold. A task emits its
counts as one row per `BLOCK` buckets, so counting shuffles at most `BUCKETS` / `BLOCK` rows per task. A table of `MARKS`
bits, broadcast, marks the hashes of the trusted ids, so that only documents whose id hits a mark are joined to their
labels: the trusted texts and few others are shuffled once, whatever the size of either table, and no text is written.
Scores are joined by id and ranked in range slices. Only the counts by bucket and the threshold reach the driver.

Edge cases: a null or empty text has zero counts, score 0 and fails the base rules; a text of fewer than
`GRAM` bytes has score 0. Repeated rows are judged alike, each on its own row. Without any trusted document
both multinomials are the raw one, every score is 0 and the base rules decide alone. Extra columns are
ignored (`judge` hands on the ones named in `keep`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import chunks, pick, sums, table, text_bytes
from slowtide.operators.ordered import running_sums
from slowtide.session import materialize, ship

GRAM = 4
BUCKETS = 1 << 16
#: Buckets whose counts are sent as one row.
BLOCK = 1 << 12
#: Hash values of trusted ids that are told apart before the join.
MARKS = 1 << 24
LOST = 0.002
MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30
#: One natural-log unit in the fixed-point ratios.
UNIT = 1 << 20
CHUNK = 4 << 20
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
#: Bytes that begin a code point of a word.
_IS_WORD_CHAR = np.ones(256, bool)
_IS_WORD_CHAR[list(SPACES)] = False
_IS_WORD_CHAR[0x80:0xC0] = False

RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


@dataclass(frozen=True)
class Model:
    """Fixed-point log ratios by bucket, and the least mean that is kept."""

    ratios: np.ndarray
    threshold: float


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the gram that starts at each byte, and whether it lies inside one text."""
    if len(data) < GRAM:
        return np.zeros(len(data), np.uint32), np.zeros(len(data), bool)
    mixed = np.zeros(len(data), np.uint32)
    for k in range(GRAM):
        mixed[: len(data) - k] |= data[k:].astype(np.uint32) << np.uint32(8 * k)
    mixed *= np.uint32(2654435761)
    mixed >>= np.uint32(32 - BUCKETS.bit_length() + 1)
    inside = np.ones(len(data), bool)
    for k in range(1, GRAM):
        late = offsets[1:] - k
        inside[late[late >= offsets[:-1]]] = False
    return mixed, inside


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of `WINDOW` words found at least twice in the text.

    Equal windows have equal rolling hashes, so a text without equal hashes has none; the rest is decided
    on the words themselves.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    one = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = one[:n].copy()
    for k in range(1, WINDOW):
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled += one[k : k + n]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    suspects = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    seen: dict[tuple, int] = {}
    windows = [tuple(words[i : i + WINDOW]) for i in suspects.tolist()]
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    starts = np.array([i for i, w in zip(suspects.tolist(), windows, strict=True) if seen[w] > 1], np.int64)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + WINDOW, -1)
    return int((np.cumsum(step)[:-1] > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def _trusted(labels: DataFrame) -> DataFrame:
    """The ids labelled good and never bad or toxic."""
    one = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("toxic").alias("high"))
    return one.filter("low = 1 and coalesce(high, 0) = 0").select("doc_id")


def _marked(docs: DataFrame, ids: DataFrame, marks: int = MARKS) -> DataFrame:
    """The documents whose id hits a bit that one of `ids` sets: all with one of the ids, and few others."""
    if docs.schema["doc_id"].dataType != ids.schema["doc_id"].dataType:  # unlike types hash unlike
        return docs
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(marks))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    # at most marks / 64 rows
    table = ids.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    hit = (F.shiftright(slot, 6) == F.col("word")) & (F.col("bits").bitwiseAND(bit) != 0)
    return docs.join(F.broadcast(table), hit, "left_semi")


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with one of the ids, by the same plan at every size."""
    return rows.join(ids.hint("merge"), "doc_id", "left_semi")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for a, b in chunks(offsets, CHUNK):
            buckets, inside = grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            n += np.bincount(buckets[inside], minlength=BUCKETS)
    yield _blocks(n)


def _blocks(n: np.ndarray) -> pa.RecordBatch:
    """The blocks of buckets that have counts."""
    blocks = n.reshape(-1, BLOCK)
    met = np.flatnonzero(blocks.any(axis=1))
    ends = np.arange(len(met) + 1, dtype=np.int32) * BLOCK
    return pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(blocks[met].ravel()))], names=["block", "n"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks = np.zeros((BUCKETS // BLOCK, BLOCK), np.int64)
    for batch in batches:
        if batch.num_rows:
            np.add.at(blocks, batch.column("block").to_numpy(), batch.column("n").flatten().to_numpy().reshape(-1, BLOCK))
    yield _blocks(blocks.ravel())


def _counted(texts: DataFrame) -> np.ndarray:
    """Grams by bucket of all texts."""
    schema = "block int, n array<long>"
    found = texts.select("text").mapInArrow(_counts, schema).repartition("block").mapInArrow(_added, schema).toArrow()
    counts = np.zeros((BUCKETS // BLOCK, BLOCK))
    if found.num_rows:
        counts[found.column("block").to_numpy()] = found.column("n").combine_chunks().flatten().to_numpy().reshape(-1, BLOCK)
    return counts.ravel()


def _means(data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    buckets, inside = grams(data, offsets)
    return sums(np.where(inside, ratios[buckets], 0), offsets) / np.maximum(sums(inside, offsets), 1) / UNIT


def fit(docs: DataFrame, labels: DataFrame, lost: float = LOST) -> Model:
    """Count both multinomials (`BUCKETS` rows of each reach the driver) and set the threshold."""
    ship(docs.sparkSession)
    texts = pick(docs, "doc_id", "text")
    ids = materialize(_trusted(pick(labels, "doc_id", "quality", "toxic")), "trusted")
    marked = _marked(texts, ids)
    counts = np.stack([_counted(texts), _counted(_among(marked, ids))])
    if not counts[1].any():
        return Model(np.zeros(BUCKETS, np.int64), 0.0)
    p = np.log((counts + 1) / (counts.sum(axis=1, keepdims=True) + BUCKETS))
    ratios = np.rint((p[1] - p[0]) * UNIT).astype(np.int64)

    def scored(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets, CHUNK):
                means = _means(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ratios)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(means)], names=["doc_id", "score"])

    told = marked.mapInArrow(scored, marked.select("doc_id").schema.add("score", "double"))
    scores = materialize(_among(told, ids).groupBy("score").agg(F.count("*").alias("n")), "scores")
    total = scores.agg(F.sum("n")).first()[0]
    upto = running_sums(scores, [], [F.col("score")], {"upto": F.col("n")})
    return Model(ratios, float(upto.filter(F.col("upto") > lost * total).agg(F.min("score")).first()[0]))


def judge(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the columns in `keep`, the base counts, score and verdict."""
    ship(docs.sparkSession)
    source = docs.select(*dict.fromkeys([*keep, text]))
    kept = [source.schema[k] for k in keep]
    out = source.select(*keep).schema
    from pyspark.sql.types import _parse_datatype_string

    for field in _parse_datatype_string(RULES):
        out = out.add(field)
    ratios, threshold = model.ratios, model.threshold

    def rows(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            for a, b in chunks(offsets, CHUNK):
                part, ends = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                whole = part.tobytes()
                texts = [whole[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                split = [t.split() for t in texts]
                n_words = np.array([len(w) for w in split], np.int64)
                again = np.array([repeated_words(w) for w in split], np.int64)
                failed = (n_words < MIN_WORDS) | (100 * again > REPEAT_PERCENT * n_words)
                score = _means(part, ends, ratios)
                added = {
                    "n_words": n_words, "word_chars": sums(_IS_WORD_CHAR[part], ends), "n_symbols": sums(_IS_SYMBOL[part], ends),
                    "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64), "n_repeat_words": again,
                    "base_failed": failed, "score": score, "kept": ~failed & (score >= threshold),
                }
                held = [batch.column(f.name).slice(a, b - a) for f in kept]
                yield pa.RecordBatch.from_arrays([*held, *map(pa.array, added.values())], names=[*[f.name for f in kept], *added])

    return source.mapInArrow(rows, out)


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(pick(docs, "doc_id", "text"), fit(docs, labels))
