"""Nearest past fix by cosine similarity."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slowtide.session import materialize, ship

# Fixed value: a hit must be more similar than this.
SIMILAR = 0.7
# lookups and entries of one matrix product, and rows of either side that meet in one task
STRIP, CHUNK, PART = 512, 8192, 65536
# Pivots of the index at most, the entries they are chosen from, rings of angle around each at most, and entries that a
# cell should hold before there is another one.
PIVOTS, SAMPLE, RINGS, CELL = 64, 4096, 16, 16384
# Angles are compared with this margin; arccos is exact to about 1e-8 near 0.
SLACK = 1e-6


def best_columns(sims: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's k largest entries in order, the smaller place first among equals."""
    if sims.shape[1] > 4 * k:
        # at least as large as the k-th largest: few columns, unless there are many ties
        cut = np.partition(sims, sims.shape[1] - k, axis=1)[:, -k]
        some = np.flatnonzero((sims >= cut[:, None]).any(axis=0))
        return some[np.argsort(-sims[:, some], axis=1, kind="stable")[:, :k]]
    return np.argsort(-sims, axis=1, kind="stable")[:, :k]


def _ones(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of a list column, and which rows have a direction; those that have none are left out."""
    usable = np.ones(len(vectors), bool)
    flat, sizes = vectors.flatten(), np.diff(vectors.offsets.to_numpy())
    if vectors.null_count or flat.null_count or not len(sizes) or (sizes != sizes[0]).any():
        rows = vectors.to_pylist()
        usable = np.array([v is not None and None not in v for v in rows], bool)
        if not usable.any():
            return np.zeros((0, 1)), usable
        stacked = np.array([v for v, u in zip(rows, usable, strict=True) if u], np.float64)
    else:
        stacked = flat.to_numpy().reshape(len(vectors), -1)
    lengths = np.linalg.norm(stacked, axis=1)
    fine = np.isfinite(lengths) & (lengths > 0)
    usable[np.flatnonzero(usable)[~fine]] = False
    return stacked[fine] / lengths[fine, None], usable


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] if len(rows) else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel() if len(rows) else np.zeros(0)))


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n different rows of unit vectors, each at the largest angle from those before it."""
    if not len(sample):
        return sample
    chosen = sample[:1]
    away = _angles(sample, chosen)[:, 0]
    while len(chosen) < n and away.max(initial=0) > SLACK:
        chosen = np.concatenate([chosen, sample[away.argmax()][None]])
        away = np.minimum(away, _angles(sample, chosen[-1:])[:, 0])
    return chosen


class Index:
    """The history in cells: nearest pivot and ring of its angle, with the true range of angles of each cell."""

    def __init__(self, pivots: np.ndarray, rings: int, cells: pd.DataFrame, rows: DataFrame):
        self.pivots, self.rings, self.rows = pivots, rings, rows
        self.cell = cells["cell"].to_numpy()
        self.low, self.high, self.n = cells["low"].to_numpy(), cells["high"].to_numpy(), cells["n"].to_numpy()

    def parts(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """First part of each cell, and in how many parts it lies: small neighbours share one, none holds above about `most` entries."""
        first, split, part, held = np.zeros(len(self.n), np.int64), -(-self.n // most), -1, most
        for i, n in enumerate(self.n):
            if held + n > most:
                part, held = part + 1, 0
            first[i], held = part, held + n
            if split[i] > 1:
                part, held = part + split[i] - 1, most
        return first, split


def least_angles(units: np.ndarray, pivots: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of each row and cell, an angle that no entry of the cell is nearer than (triangle inequality); `owner` is the cell's pivot."""
    away = _angles(units, pivots)[:, owner]
    return np.maximum(0.0, np.maximum(away - high, low - away))


def build_index(history: DataFrame, pivots: int = PIVOTS, cell: int = CELL) -> Index:
    """Index every entry (entry_id, vector) that has a direction; pivots come from at most `SAMPLE` of them.

    There is a cell for about every `cell` entries, up to `pivots` pivots and then up to `RINGS` rings around each.
    """
    ship(history.sparkSession)
    wanted = -(-max(1, history.count()) // cell)
    pivots = min(pivots, wanted)
    rings = min(RINGS, -(-wanted // pivots))
    source = history.select("entry_id", F.col("vector").cast("array<double>").alias("vector"))
    sample = source.orderBy(F.xxhash64("entry_id"), "entry_id").limit(SAMPLE).toArrow()
    units, _ = _ones(sample.column("vector").combine_chunks())
    chosen = farthest_first(units, pivots)

    def keyed(batches):
        for batch in batches:
            unit, usable = _ones(batch.column("vector"))
            if not len(unit) or not len(chosen):
                continue
            away = _angles(unit, chosen)
            nearest = away.argmin(axis=1)
            angle = away[np.arange(len(unit)), nearest]
            cell = nearest * rings + np.minimum(angle / np.pi * rings, rings - 1).astype(int)
            kept = batch.column("entry_id").filter(pa.array(usable))
            yield pa.RecordBatch.from_arrays([kept, _lists(unit), pa.array(cell.astype(np.int32)), pa.array(angle)], names=["entry_id", "unit", "cell", "angle"])

    rows = materialize(source.mapInArrow(keyed, "entry_id bigint, unit array<double>, cell int, angle double"), "index")
    # at most PIVOTS * RINGS rows
    cells = rows.groupBy("cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")).orderBy("cell").toPandas()
    return Index(chosen, rings, cells, rows)


Visit = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _seen(index: Index, visit: Visit) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Of some lookups and each cell, whether the lookup visits it."""
    pivots, owner, low, high = index.pivots, index.cell // index.rings, index.low, index.high
    return lambda unit, floor: visit(least_angles(unit, pivots, owner, low, high), floor)


def _routes(lookups: DataFrame, index: Index, visit: Visit, first: np.ndarray, split: np.ndarray) -> DataFrame:
    """A row for each lookup and part that holds a cell it visits."""
    seen = _seen(index, visit)
    # cells of one part stand side by side
    heads = np.flatnonzero(np.diff(first, prepend=-1))

    def routed(batches):
        for batch in batches:
            if not len(first):
                continue
            for start in range(0, batch.num_rows, STRIP):
                strip = batch.slice(start, STRIP)
                visits = seen(_matrix(strip.column("unit")), strip.column("floor").to_numpy())
                at, which = np.nonzero(np.logical_or.reduceat(visits, heads, axis=1))
                times = split[heads[which]]
                at, part = np.repeat(at, times), np.repeat(first[heads[which]] - np.cumsum(times) + times, times) + np.arange(times.sum())
                for some in range(0, len(at), CHUNK):
                    columns = [strip.column(n).take(pa.array(at[some : some + CHUNK])) for n in ("lookup_id", "unit", "floor")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(part[some : some + CHUNK].astype(np.int32))], names=["lookup_id", "unit", "floor", "part"])

    return lookups.mapInArrow(routed, "lookup_id bigint, unit array<double>, floor double, part int")


def _met(lookups: DataFrame, index: Index, visit: Visit, k: int, exclude_same_id: bool, block_rows: int, part_rows: int) -> DataFrame:
    """(lookup_id, entry_id, similarity): the k best entries of each lookup in each part it visits, if above its floor."""
    first, split = index.parts(part_rows)
    routes = materialize(_routes(lookups, index, visit, first, split), "routes")
    # at most PIVOTS * RINGS rows
    placed = F.broadcast(lookups.sparkSession.createDataFrame(list(zip(index.cell.tolist(), first.tolist(), split.tolist())), "cell int, first int, split int"))
    held = index.rows.join(placed, "cell").withColumn("part", (F.col("first") + F.pmod(F.xxhash64("entry_id"), "split")).cast("int"))
    # a row for each part: the lookups that visit it are cut into shares of about part_rows
    shares = F.broadcast(routes.groupBy("part").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("shares")))
    left = routes.join(shares, "part").select("part", F.pmod(F.xxhash64("lookup_id"), "shares").cast("int").alias("share"), "lookup_id", "unit", "floor")
    right = held.join(shares, "part").select("part", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "entry_id", "unit", "cell")
    seen, cells, rows = _seen(index, visit), index.cell, min(block_rows, STRIP)

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        schema = pa.schema([("lookup_id", pa.int64()), ("entry_id", pa.int64()), ("similarity", pa.float64())])
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        b = b.sort_by("entry_id")
        entries = Entries(b.column("entry_id").to_numpy(), _matrix(b.column("unit")), np.searchsorted(cells, b.column("cell").to_numpy()))
        units, floors, wanted = _matrix(a.column("unit")), a.column("floor").to_numpy(), a.column("lookup_id").to_numpy()
        # lookups that visit the same cells stand side by side
        near = [seen(units[i : i + STRIP], floors[i : i + STRIP]).argmax(axis=1) for i in range(0, len(units), STRIP)]
        order = np.argsort(np.concatenate(near), kind="stable")
        found = []
        for start in range(0, len(order), rows):
            strip = order[start : start + rows]
            at, place, value = entries.best(units[strip], floors[strip], seen(units[strip], floors[strip]), k, wanted[strip] if exclude_same_id else None)
            found.append(pa.table([wanted[strip][at], entries.ids[place], value], schema=schema))
        return pa.concat_tables(found)

    return left.groupBy("part", "share").cogroup(right.groupBy("part", "share")).applyInArrow(best, "lookup_id bigint, entry_id bigint, similarity double")


class Entries:
    """Entries of one part in order of their ids, with the place of their cells."""

    def __init__(self, ids: np.ndarray, units: np.ndarray, cells: np.ndarray):
        self.ids, self.units, self.cells, self.short = ids, units, cells, units.astype(np.float32)
        # above the rounding error of a product of unit vectors in single precision
        self.margin = (units.shape[1] + 8) * 2.4e-7

    def best(self, units: np.ndarray, floors: np.ndarray, seen: np.ndarray, k: int, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, place and similarity of each row's k best entries in the cells it has `seen` that reach its floor.

        Products in single precision find the few entries that can reach a row's floor or its k-th best so far; their
        similarities are taken again in double precision. Where there are many (ties, low floors) all are.
        """
        short, cut = units.astype(np.float32), floors.astype(np.float64)
        at, place, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        columns = np.flatnonzero(seen.any(axis=0)[self.cells])
        for start in range(0, len(columns), CHUNK):
            some = columns[start : start + CHUNK]
            sims = short @ self.short[some].T
            self._omit(sims, some, own)
            row, which = np.nonzero(sims >= (cut - self.margin).astype(np.float32)[:, None])
            if len(row) > 16 * k * len(units):
                sims = np.round(units @ self.units[some].T, 12)
                sims[~seen[:, self.cells[some]]] = -np.inf
                self._omit(sims, some, own)
                top = best_columns(sims, k)
                row, which = np.repeat(np.arange(len(units)), top.shape[1]), top.ravel()
                new = sims[row, which]
            else:
                mine = seen[row, self.cells[some[which]]]
                row, which = row[mine], which[mine]
                # rounded, so that equal vectors tie whatever part they are in
                new = np.round(np.einsum("ij,ij->i", units[row], self.units[some[which]]), 12)
            # the floor is a similarity that k entries reach already: ties with it still count
            good = np.isfinite(new) & (new >= cut[row])
            if not good.any():
                continue
            at, place, value = np.concatenate([at, row[good]]), np.concatenate([place, some[which[good]]]), np.concatenate([value, new[good]])
            order = np.lexsort((place, -value, at))
            rank = np.arange(len(order)) - np.searchsorted(at[order], at[order])
            kept = order[rank < k]
            at, place, value = at[kept], place[kept], value[kept]
            last = rank[rank < k] == k - 1
            cut[at[last]] = value[last]
        return at, place, value

    def _omit(self, sims: np.ndarray, some: np.ndarray, own: np.ndarray | None) -> None:
        """No row meets the entry of its own id."""
        if own is not None:
            at = np.minimum(np.searchsorted(self.ids[some], own), len(some) - 1)
            same = np.flatnonzero(self.ids[some[at]] == own)
            sims[same, at[same]] = -np.inf


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def similar_fixes(
    lookups: DataFrame,
    history: DataFrame,
    threshold: float = SIMILAR,
    k: int = 1,
    exclude_same_id: bool = False,
    block_rows: int = 16384,
    index: Index | None = None,
    part_rows: int = PART,
) -> DataFrame:
    """For each lookup (lookup_id, vector) its k most similar history entries (entry_id, vector)
    above the threshold; the smaller entry_id wins ties. Ids are unique and not null (else an error).

    Exact at any size. Entries lie in cells around pivots, by angle. A lookup first meets the cell that could hold the
    nearest entry; then it meets only the cells that, by the triangle inequality on angles, could hold one above the
    threshold and as near as its k-th best so far. Neighbouring cells lie in parts of about `part_rows` entries, and of the
    lookups that visit a part about as many at a time meet it in one task, in matrix products of at most `block_rows`
    and `STRIP` lookups; a row is sent once for each part or share that it meets. No pair is emitted
    but the k best of each part. A lookup without a direction (null, zero, not finite) finds nothing.
    """
    spark = lookups.sparkSession
    ship(spark)
    rows, most = max(1, int(block_rows)), max(1, int(part_rows))
    for side, name in ((lookups, "lookup_id"), (history, "entry_id")):
        n, different = side.agg(F.count("*"), F.count_distinct(name)).first()
        if n != different:
            raise ValueError(f"{name} must be unique and not null: {n} rows, {different} values")
    index = index or build_index(history)

    def directed(batches):
        for batch in batches:
            unit, usable = _ones(batch.column("vector"))
            kept = batch.column("lookup_id").filter(pa.array(usable))
            yield pa.RecordBatch.from_arrays([kept, _lists(unit)], names=["lookup_id", "unit"])

    units = materialize(lookups.select("lookup_id", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(directed, "lookup_id bigint, unit array<double>"), "lookups")
    start = F.lit(float(threshold))
    home = _met(units.withColumn("floor", start), index, _home, k, exclude_same_id, rows, most)
    home = materialize(home.filter(F.col("similarity") > threshold), "home")
    order = Window.partitionBy("lookup_id").orderBy(F.col("similarity").desc(), "entry_id")
    if len(index.cell) > 1:
        reached = home.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select("lookup_id", F.col("similarity").alias("reached"))
        again = units.join(reached, "lookup_id", "left").select("lookup_id", "unit", F.coalesce("reached", start).alias("floor"))
        rest = _met(again, index, _others, k, exclude_same_id, rows, most)
        home = home.union(rest.filter(F.col("similarity") > threshold))
    return home.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def visited_pairs(lookups: DataFrame, index: Index, threshold: float = SIMILAR) -> int:
    """Pairs of lookup and entry that the angles do not rule out at this threshold, before any entry is met."""
    known = lookups.select("lookup_id", F.col("vector").cast("array<double>").alias("unit"))
    unit = F.transform("unit", lambda x: x / F.sqrt(F.aggregate("unit", F.lit(0.0), lambda s, y: s + y * y)))
    seen, sizes = _seen(index, lambda least, floor: least <= _reach(floor)), index.n

    def counted(batches):
        for batch in batches:
            parts = [_matrix(batch.column("unit").slice(i, STRIP)) for i in range(0, batch.num_rows, STRIP)]
            yield pa.RecordBatch.from_arrays([pa.array([int((seen(p, np.full(len(p), threshold)) @ sizes).sum()) for p in parts], pa.int64())], names=["pairs"])

    return known.select(unit.alias("unit")).mapInArrow(counted, "pairs bigint").agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]


def _reach(floor: np.ndarray) -> np.ndarray:
    """The angle up to which an entry has at least this similarity, and a margin above float and rounding error."""
    return np.arccos(np.clip(floor, -1.0, 1.0))[:, None] + SLACK


def _home(least: np.ndarray, floor: np.ndarray) -> np.ndarray:
    first = np.zeros(least.shape, bool)
    first[np.arange(len(least)), least.argmin(axis=1)] = True
    return first & (least <= _reach(floor))


def _others(least: np.ndarray, floor: np.ndarray) -> np.ndarray:
    return (least <= _reach(floor)) & ~_home(least, floor)


def with_similar_fix(lookups: DataFrame, history: DataFrame, **options) -> DataFrame:
    """Every lookup with its best entry, NULL when none is similar enough."""
    best = similar_fixes(lookups, history, k=1, **options).drop("rank")
    return lookups.join(best, "lookup_id", "left")


def similarity_stats(found: DataFrame) -> DataFrame:
    """Lookups, lookups with a similar fix, and the mean similarity of those."""
    return found.agg(
        F.count("*").alias("lookups"),
        F.count("entry_id").alias("found"),
        F.avg(F.when(F.col("similarity") != 0, F.col("similarity"))).alias("mean_similarity"),
    )
