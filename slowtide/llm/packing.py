"""Packing token sequences by patterns of a few lengths, fitted with non-negative least squares.

Texts become pieces of at most `LIMIT` ids (only longer texts are cut). The histogram of piece lengths, which
has at most `LIMIT` rows whatever the input, goes to the driver. There, all patterns of two and three lengths that
fill a sequence exactly are enumerated (about 350,000 at most); multiplicative updates fit non-negative repeat counts
whose use of each length comes nearest to the histogram; counts are rounded down. The same is tried with patterns that
leave some waste, over the `HOT` most frequent lengths left, and what is left over then is packed best fit decreasing,
again on counts. Where the fewest sequences so far exceed what the ids need, patterns of any number of lengths are priced:
a knapsack over the lengths finds the pattern that fills a sequence (but for a stated waste) and gains most by what the fit
still lacks of each length, and the fit goes on with it, until no pattern gains. The plan of fewest sequences counts; as
bin packing is hard, it may still miss the optimum. The plan (how often each pattern is used) is bounded by the number of
patterns. Spark then gives the k-th piece of a length its place: pieces are numbered within length by task and
then by the tasks before, so a length that most pieces share is still spread over all tasks.

Edge cases: a null or empty text is its end id alone. Repeated rows and null ids are packed like any other. An
empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slowtide.llm.common import pick
from slowtide.llm.tokens import encoded, encoder
from slowtide.session import materialize, ship

LIMIT = 2048
END = 0
#: So many of the most frequent lengths that the exact patterns leave over form patterns with some waste ..
HOT = 96
#: .. of at most this share of a sequence, each tried.
WASTES = (32, 8)
ROUNDS = 300
#: Waste that priced patterns may leave (as a share of a sequence; 0: none), patterns at most, passes, and whether a pass
#: takes its strongest pattern only.
PRICINGS = ((0, 64, 2, False), (0, 12, 8, True), (256, 64, 1, False), (64, 64, 1, False))


def patterns(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """All rows of two or three lengths (0: none) that occur and add up to the limit."""
    have = np.flatnonzero(counts[:limit])
    have = have[have > 0]
    a, b = np.meshgrid(have, have, indexing="ij")
    a, b = a[a <= b], b[a <= b]
    c = limit - a - b
    three = c >= b
    three[three] = counts[c[three]] > 0
    pair = have[(2 * have <= limit)]
    pair = pair[counts[limit - pair] > 0]
    return np.concatenate([np.stack([a[three], b[three], c[three]], axis=1), np.stack([pair, limit - pair, np.zeros_like(pair)], axis=1)]).astype(np.int64)


def loose(counts: np.ndarray, waste: int, limit: int = LIMIT, hot: int = HOT) -> np.ndarray:
    """Rows of two or three of the `hot` most frequent lengths (0: none) that leave at most `waste` of the limit."""
    have = np.flatnonzero(counts[:limit])
    have = have[have > 0]
    have = np.sort(have[np.argsort(-counts[have], kind="stable")[:hot]])
    a, b, c = (x.ravel() for x in np.meshgrid(np.append(0, have), have, have, indexing="ij"))
    total = a + b + c
    fits = (a <= b) & (b <= c) & (total <= limit) & (total >= limit - waste)
    return np.stack([c[fits], b[fits], a[fits]], axis=1).astype(np.int64)


def repeats(found: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative counts x of the patterns that bring the lengths they use near `counts`, by least squares.

    Each round multiplies x by (A'h) / (A'Ax), which never raises the squared error and keeps x positive.
    """
    if not len(found):
        return np.zeros(0)
    goal = counts.astype(float).copy()
    goal[0] = 0
    use = found > 0
    x = np.full(len(found), goal.sum() / max(1, use.sum()))
    up = (goal[found] * use).sum(axis=1)
    for _ in range(rounds):
        used = np.bincount(found.ravel(), (x[:, None] * use).ravel(), minlength=len(goal))
        x *= up / np.maximum((used[found] * use).sum(axis=1), 1e-12)
    return x


def best_fit(left: np.ndarray, limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over counts per length: (lengths, times) of the sequences."""
    open_at: dict[int, list] = {}
    gaps: list[int] = []
    done = []

    def put(pattern: tuple, times: int, gap: int) -> None:
        if gap == 0:
            done.append((pattern, times))
            return
        if gap not in open_at:
            open_at[gap] = []
            insort(gaps, gap)
        open_at[gap].append((pattern, times))

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            k = bisect_left(gaps, length)
            if k < len(gaps):
                gap = gaps[k]
                pattern, times = open_at[gap].pop()
                if not open_at[gap]:
                    del open_at[gap]
                    gaps.pop(k)
                take = min(n, times)
                if times > take:
                    put(pattern, times - take, gap)
                put((*pattern, length), take, gap - length)
                n -= take
            else:
                each = limit // length
                full, rest = divmod(n, each)
                if full:
                    put((length,) * each, full, limit - each * length)
                if rest:
                    put((length,) * rest, 1, limit - rest * length)
                n = 0
    return done + [x for gap in gaps for x in open_at[gap]]


def _take(found: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Fitted repeats of the patterns, taken off `left`."""
    # rounded down: what is left over then keeps short pieces to go with the long ones
    whole, out = np.floor(repeats(found, left) + 1e-9).astype(np.int64), []
    for k in np.flatnonzero(whole).tolist():
        lengths = tuple(v for v in found[k].tolist() if v)
        times = min([int(whole[k]), *[int(left[v]) // lengths.count(v) for v in lengths]])
        if times:
            for v in lengths:
                left[v] -= times
            out.append((lengths, times))
    return out


def knapsack(lengths: np.ndarray, value: np.ndarray, limit: int, least: int) -> np.ndarray | None:
    """How often each length stands in the pattern of `least` to `limit` ids whose values add up highest; None without one."""
    best, last = np.full(limit + 1, -np.inf), np.full(limit + 1, -1)
    best[0] = 0
    for c in range(int(lengths[0]), limit + 1):
        fits = int(np.searchsorted(lengths, c, side="right"))
        gain = best[c - lengths[:fits]] + value[:fits]
        last[c] = gain.argmax()
        best[c] = gain[last[c]]
    at = least + int(best[least:].argmax())
    if not np.isfinite(best[at]):
        return None
    use = np.zeros(len(lengths), np.int64)
    while at:
        use[last[at]] += 1
        at -= int(lengths[last[at]])
    return use


def priced(left: np.ndarray, waste: int, limit: int = LIMIT, most: int = 64, eager: bool = False) -> list[tuple[tuple[int, ...], int]]:
    """Sequences of patterns of any number of lengths that leave at most `waste`, taken off `left`.

    Patterns are added one at a time: the one that gains most by the residual of the least-squares fit of those so far.
    """
    lengths = np.flatnonzero(left[: limit + 1])
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return []
    goal = left[lengths].astype(float)
    used, x, known = np.zeros((0, len(lengths))), np.zeros(0), set()
    while len(x) < most:
        lacking = goal - used.T @ x
        pattern = knapsack(lengths, lacking, limit, limit - waste)
        if pattern is None or pattern.tobytes() in known or pattern @ lacking <= 1e-6 * goal.max():
            break
        known.add(pattern.tobytes())
        used = np.vstack([used, pattern])
        x = np.append(x, max(1.0, (pattern @ lacking) / (pattern @ pattern)))
        square, up = used @ used.T, used @ goal
        for _ in range(ROUNDS):
            x *= up / np.maximum(square @ x, 1e-12)
    out = []
    for k in np.argsort(-x, kind="stable")[: 1 if eager else None].tolist():
        on = used[k] > 0
        reach = int((left[lengths[on]] // used[k][on].astype(np.int64)).min())
        # the nearest whole number of repeats, as far as the lengths reach
        times = reach if eager else min(int(np.rint(x[k])), reach)
        if times:
            left[lengths[on]] -= times * used[k][on].astype(np.int64)
            out.append((tuple(np.repeat(lengths, used[k].astype(np.int64))[::-1].tolist()), times))
    return out


def least_sequences(counts: np.ndarray, limit: int = LIMIT) -> int:
    """What the ids alone need, or the pieces longer than half a sequence."""
    return max(-(-int(counts @ np.arange(limit + 1)) // limit), int(counts[limit // 2 + 1 :].sum()))


def plan(counts: np.ndarray, limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, times) of all sequences; each length is used as often as it occurs.

    The one of fewest sequences of: best fit decreasing alone, after the exact patterns, after those and loose ones, and,
    if these need more than `least_sequences`, after priced patterns.
    """
    left = counts.astype(np.int64).copy()
    full = [((limit,), int(left[limit]))] if left[limit] else []
    left[limit] = 0
    start = left.copy()
    made = [best_fit(left, limit)]
    exact = _take(patterns(left, limit), left)
    made.append(exact + best_fit(left, limit))
    for share in WASTES:
        rest = left.copy()
        made.append(exact + _take(loose(rest, limit // share, limit), rest) + best_fit(rest, limit))
    size = lambda m: sum(times for _, times in m)
    need = least_sequences(start, limit)
    # what rounding leaves is fitted again; then the same with the strongest pattern alone, as often as it goes
    for share, most, passes, eager in PRICINGS:
        rest, taken = start.copy(), []
        for _ in range(passes):
            if min(map(size, made)) <= need:
                break
            new = priced(rest, limit // share if share else 0, limit, most, eager)
            if not new:
                break
            taken = taken + new
            made.append(taken + best_fit(rest, limit))
    return full + min(made, key=size)


def _places(made: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (length << 40 | first rank), and for each the sequence of that rank and the offset there."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in made:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length << 40 | rank, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    rows.sort()
    keys, first, offset = zip(*rows, strict=True) if rows else ((), (), ())
    return np.array(keys, np.int64), np.array(first, np.int64), np.array(offset, np.int64)


def pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), written once.

    `part` and `turn` number the pieces of a length within the task that made them.
    """
    ship(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, turn long" + (", ids array<int>" if with_ids else "")

    def rows(batches):
        part, met = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            names = batch.column("doc_id")
            for a, b, found, ends in encoded(batch.column("text"), encoder(tokenizer), end):
                sizes = np.diff(ends, prepend=0)
                count = -(-sizes // limit)
                doc = np.repeat(np.arange(b - a), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * limit
                length = np.minimum(limit, sizes[doc] - start)
                at = (ends - sizes)[doc] + start
                wide = found.astype("<u4")
                crc = [zlib.crc32(wide[i:j]) for i, j in zip(at.tolist(), (at + length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                same = length[order]
                rank = np.arange(len(same)) - np.searchsorted(same, same)
                turn = np.empty(len(same), np.int64)
                turn[order] = rank + met[same]
                met += np.bincount(length, minlength=limit + 1)
                columns = [
                    names.slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                    pa.array(np.full(len(doc), part, np.int32)), pa.array(turn),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(wide)).astype(np.int32)), pa.array(wide.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "turn"] + ["ids"] * with_ids)

    return materialize(docs.select("doc_id", "text").mapInArrow(rows, schema), "pieces")


def pack(cut: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (length, part and turn as `pieces` makes them)."""
    ship(cut.sparkSession)
    each = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(each.select("length", "part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "lengths")
    counts = np.zeros(limit + 1, np.int64)
    for row in before.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `limit` rows
        counts[row["length"]] = row["n"]
    keys, first, offsets = _places(plan(counts, limit))
    ranked = cut.join(before.drop("n"), ["length", "part"]).withColumn("rank", F.col("before") + F.col("turn"))
    ranked = ranked.select(*[c for c in cut.columns if c not in ("part", "turn")], "rank")
    kept = ranked.columns[:-1]

    def rows(batches):
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            key = (batch.column("length").to_numpy() << 40) | rank
            at = np.searchsorted(keys, key, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in kept], pa.array(first[at] + key - keys[at]), pa.array(offsets[at])], names=[*kept, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(rows, ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long"))


def op7_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
