"""Exact top-k inner products with a pivot-distance index.

Vectors become integers, floor(1024 x). A bounded sample gives `PIVOTS` pivots (farthest first); every vector is
keyed by its nearest pivot and its distance from it, and the table is range-partitioned by that key, so a popular
pivot or a vector with many copies is spread over several partitions. Each partition is packed into annuli of at
most `ANNULUS` vectors of one pivot, sorted by distance, and these into parts.

For a query q and an annulus around pivot p with distances [low, high] and largest norm m, the triangle inequality
gives d(q, x) >= max(0, d(q,p) - high, low - d(q,p)), hence q.x = (|q|^2 + |x|^2 - d^2) / 2 <= (|q|^2 + m^2 - d^2) / 2.
A query first meets the part that its own key could lie in; its k-th score there bounds which other
parts it must visit. In a part, annuli are expanded from the most promising outwards until no bound reaches
the query's k-th score. A bound is rounded up by a margin above float error, and ties go on, so nothing is lost.

Bounds: pivots come from at most `SAMPLE` vectors (every vector is indexed; the search is exact, so recall is 1). A part
has at most `ANNULI` annuli, which is what one task holds, and the table of parts that reaches the driver has a few
numbers for each. Queries travel in blocks of `QUERIES`, never as pairs of rows.

Edge cases: vectors that are null or hold a null or non-finite component take no part; shorter vectors are padded
with zeros. Every other row is a candidate of every query but itself, repeated rows and several rows under one id
included: rows have numbers of their own, and each row whose id is divisible is a query with its own ranks. A row without
an id is a candidate like any other (before all ids among ties) but no query. With fewer than k candidates all are
returned. Components must stay below 2^31 after scaling; larger ones raise an error. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slowtide.llm.common import pick
from slowtide.session import materialize, ship

SCALE = 1024
EVERY = 100
K = 10
PIVOTS = 32
SAMPLE = 4096
ANNULUS = 512
#: Annuli of a part.
ANNULI = 64
QUERIES = 256
#: Queries that meet a partition in one task, about; with more, several tasks share the partition.
AT_ONCE = 1 << 16
#: Squared distances are exact integers below this; beyond, products are taken in 64-bit integers.
EXACT = float(1 << 52)

#: Stands for a null id, before all others.
NO_ID = np.iinfo(np.int64).min

_RESULT = "query long, vec_id long, row long, score long"


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, row, v): the integer vectors that take part, each with a number of its own."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE))
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return pick(vectors, "vec_id", "embedding").filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.monotonically_increasing_id().alias("row"), x.alias("v"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column as an int64 matrix, padded with zeros."""
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), size), np.int64)
    out[np.arange(size) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a with all rows of b."""
    if not len(a) or not len(b) or not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n different rows, each the farthest from those before it."""
    chosen = sample[:1]
    away = ((sample - chosen[0]).astype(float) ** 2).sum(axis=1)
    while len(chosen) < n and away.max(initial=0) > 0:
        chosen = np.concatenate([chosen, sample[away.argmax()][None]])
        away = np.minimum(away, ((sample - chosen[-1]).astype(float) ** 2).sum(axis=1))
    return chosen


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a.astype(float) ** 2).sum(axis=1)[:, None] + (b.astype(float) ** 2).sum(axis=1)[None, :] - 2.0 * products(a, b)
    return np.sqrt(np.maximum(square, 0))


def bound(q_norm: np.ndarray, q_away: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Upper bound of the inner product of each query (rows) with the vectors of each annulus (columns)."""
    least = np.maximum(0, np.maximum(q_away - high[None, :], low[None, :] - q_away))
    top = (q_norm[:, None] ** 2 + norm[None, :] ** 2 - least**2) / 2
    return np.minimum(top, q_norm[:, None] * norm[None, :]) + 1 + 1e-9 * (q_norm[:, None] + norm[None, :]) ** 2


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of (query, id, row, score) each query's k highest scores, ties to the smaller id, then row; queries are numbers."""
    order = np.lexsort((found[2], found[1], -found[3], found[0]))
    found = [x[order] for x in found]
    rank = np.arange(len(order)) - np.searchsorted(found[0], found[0])
    return [x[rank < k] for x in found]


class Search:
    """The annuli of one part."""

    def __init__(self, rows: list[tuple], pivots: np.ndarray, k: int):
        self.annuli = rows
        self.pivots, self.k = pivots, k
        self.pivot = np.array([r[0] for r in rows], int)
        self.low, self.high, self.norm = (np.array([r[i] for r in rows], float) for i in (1, 2, 3))

    def answer(self, names: np.ndarray, vectors: np.ndarray, reached: np.ndarray) -> pa.RecordBatch:
        """Candidates of these queries that could be among their k best; `reached` is a score already known."""
        q_norm = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        away = distances(vectors, self.pivots)[:, self.pivot]
        tops = bound(q_norm, away, self.low, self.high, self.norm)
        kept = [np.zeros(0, np.int64)] * 4
        floor = reached.astype(float).copy()
        for j in np.argsort(-tops.max(axis=0), kind="stable"):
            open_ = np.flatnonzero(tops[:, j] >= floor)
            if not len(open_):
                continue
            _, _, _, _, ids, rows, matrix = self.annuli[j]
            score = products(vectors[open_], matrix)
            hit = (score >= floor[open_][:, None]) & (rows[None, :] != names[open_][:, None])
            at, which = np.nonzero(hit)
            kept = _best([np.concatenate(x) for x in zip(kept, (open_[at], ids[which], rows[which], score[at, which]), strict=True)], self.k)
            last = np.flatnonzero(np.bincount(kept[0], minlength=len(names)) >= self.k)
            if len(last):
                end = np.searchsorted(kept[0], last, side="right") - 1
                floor[last] = np.maximum(floor[last], kept[3][end])
        ids = pa.array(kept[1], mask=kept[1] == NO_ID)
        return pa.RecordBatch.from_arrays([pa.array(names[kept[0]]), ids, pa.array(kept[2]), pa.array(kept[3])], names=["query", "vec_id", "row", "score"])


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    ship(spark)
    rows = materialize(scaled(vectors), "vectors")
    widest = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    size = max(1, widest[0] or 1)
    if (widest[1] or 0) >= 1 << 31:
        raise ValueError("components are too large for exact integer scores")
    sample = rows.orderBy(F.xxhash64("vec_id", "row"), "row").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = farthest_first(_matrix(sample.column("v").combine_chunks(), size), PIVOTS)

    def keyed(batches):
        for batch in batches:
            away = distances(_matrix(batch.column("v"), size), pivots)
            pivot = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("row"), batch.column("v"), pa.array(pivot.astype(np.int32)), pa.array(away[np.arange(len(pivot)), pivot])],
                names=["vec_id", "row", "v", "pivot", "away"],
            )

    keys = rows.mapInArrow(keyed, "vec_id long, row long, v array<bigint>, pivot int, away double")

    def annuli(batches):
        task, made, held, pivot = TaskContext.get().partitionId(), 0, [], None

        def close():
            ids, numbers = np.array([r[0] for r in held], np.int64), np.array([r[1] for r in held], np.int64)
            matrix = np.array([np.frombuffer(r[2], np.int64) for r in held])
            norm = float(np.sqrt((matrix.astype(float) ** 2).sum(axis=1)).max())
            narrow = matrix.astype(np.int32)
            part = task << 32 | made // ANNULI
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in ((part, pa.int64()), (pivot, pa.int32()), (held[0][3], pa.float64()), (held[-1][3], pa.float64()), (norm, pa.float64()), (ids.tobytes(), pa.binary()), (numbers.tobytes(), pa.binary()), (narrow.tobytes(), pa.binary()))],
                names=["part", "pivot", "low", "high", "norm", "ids", "rows", "matrix"],
            )

        for batch in batches:
            matrix = _matrix(batch.column("v"), size)
            names = batch.column("vec_id").fill_null(int(NO_ID)).to_pylist()
            for i, (name, row, p, away) in enumerate(zip(names, *[batch.column(c).to_pylist() for c in ("row", "pivot", "away")], strict=True)):
                if held and (p != pivot or len(held) >= ANNULUS):
                    yield close()
                    held, made = [], made + 1
                pivot = p
                held.append((name, row, matrix[i].tobytes(), away))
        if held:
            yield close()

    index = materialize(
        keys.repartitionByRange("pivot", "away", "row").sortWithinPartitions("pivot", "away", "row").mapInArrow(
            annuli, "part long, pivot int, low double, high double, norm double, ids binary, rows binary, matrix binary"
        ),
        "annuli",
    )
    # a few numbers for each part of up to ANNULI * ANNULUS vectors
    parts = index.groupBy("part", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("norm").alias("norm")).orderBy("part", "pivot").toPandas()

    def blocks(asked: DataFrame, pick_parts) -> DataFrame:
        """One row per block of queries and partition that they visit."""

        def sent(batches):
            turn = TaskContext.get().partitionId()
            for batch in batches:
                for a in range(0, batch.num_rows, QUERIES):
                    some = batch.slice(a, QUERIES)
                    names, matrix = some.column("row").to_numpy(), _matrix(some.column("v"), size)
                    reached = some.column("reached").to_numpy()
                    turn += 1
                    for part, on in pick_parts(matrix, reached):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([part], pa.int64()), pa.array([turn % shares], pa.int32()), *[pa.array([x[on].tobytes()], pa.binary()) for x in (names, matrix, reached)]],
                            names=["part", "share", "names", "queries", "reached"],
                        )

        return asked.mapInArrow(sent, "part long, share int, names binary, queries binary, reached binary")

    def bounds(matrix):
        q_norm = np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
        away = distances(matrix, pivots)[:, parts["pivot"].to_numpy()]
        return away, bound(q_norm, away, parts["low"].to_numpy(), parts["high"].to_numpy(), parts["norm"].to_numpy())

    starts = np.flatnonzero(np.diff(parts["part"].to_numpy(), prepend=-1))
    numbers = parts["part"].to_numpy()[starts]

    def home(matrix):
        """The partition whose best annulus bounds the query highest."""
        return np.maximum.reduceat(bounds(matrix)[1], starts, axis=1).argmax(axis=1)

    def homes(matrix, reached):
        at = home(matrix)
        return [(int(numbers[p]), at == p) for p in np.unique(at)]

    def others(matrix, reached):
        tops = np.maximum.reduceat(bounds(matrix)[1], starts, axis=1)
        visit = (tops >= reached[:, None]) & (np.arange(len(starts))[None, :] != home(matrix)[:, None])
        return [(int(numbers[p]), visit[:, p]) for p in np.flatnonzero(visit.any(axis=0))]

    def searched(key, queries: pa.Table, annuli_: pa.Table) -> pa.Table:
        found = []
        for r in annuli_.to_pylist():
            ids, numbers_ = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["rows"], np.int64)
            found.append((r["pivot"], r["low"], r["high"], r["norm"], ids, numbers_, np.frombuffer(r["matrix"], np.int32).reshape(len(ids), size).astype(np.int64)))
        search, out = Search(found, pivots, k), []
        for r in queries.to_pylist():
            names = np.frombuffer(r["names"], np.int64)
            out.append(search.answer(names, np.frombuffer(r["queries"], np.int64).reshape(len(names), size), np.frombuffer(r["reached"], np.int64)))
        empty = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])
        return pa.Table.from_batches(out, empty)

    def visited(sent: DataFrame) -> DataFrame:
        copies = index.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        return sent.groupBy("part", "share").cogroup(copies.groupBy("part", "share")).applyInArrow(searched, _RESULT)

    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_first(), "row")
    lowest = F.lit(np.iinfo(np.int64).min)
    asked = rows.filter(F.col("vec_id") % every == 0)
    shares = -(-max(1, asked.count()) // AT_ONCE)
    near = materialize(visited(blocks(asked.withColumn("reached", lowest), homes)), "near")
    reached = near.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    reached = reached.select("query", F.when(F.col("n") >= k, F.col("least")).otherwise(lowest).alias("reached"))
    known = asked.join(reached, F.col("row") == F.col("query"), "left").select("row", "v", F.coalesce("reached", lowest).alias("reached"))
    ranked = near.union(visited(blocks(known, others))).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    named = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(named, "query").select("query_id", "rank", "vec_id", "score")


def op9_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


CHECK = """
WITH whole AS (
    SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.row_no AS query, q.vec_id AS query_id, c.vec_id, c.row_no, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.row_no <> c.row_no
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS FIRST, row_no) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
