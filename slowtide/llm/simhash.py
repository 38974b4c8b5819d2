"""Near duplicates by SimHash: a binary trie joined with itself.

Every text gets a 64-bit fingerprint of its 3-word shingles, with `lower` (as in `op4_simhash` and the pipeline) of
the text with A-Z, and no other letters, in lower case. The distinct fingerprints form a binary trie,
cut into subtrees of at most `SUBTREE` fingerprints; a subtree that holds more (a cluster of near copies) is
cut deeper, so no task gets an unbounded one. Spark walks pairs of trie nodes together from the root, `STEP`
bits a level, adds up the bits in which the two paths differ, and drops a pair once they exceed the budget.
The surviving pairs of subtrees are walked on in numpy, bit by bit, in the same way. A pair of subtrees
emits a spanning forest over the components already found inside each, never all of its pairs; components
of the whole graph then come from star contraction.

Edge cases: equal fingerprints (exact copies, however many) are one node from the start. A null or empty
text has fingerprint zero and is linked like any other; fewer than three words make one shingle. A null
doc_id gives a row but no id, so `component_id` is null where no row of a component has an id. Repeated rows
each give a row. An empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.llm.common import chunks, numbered, pick, text_bytes
from slowtide.llm.components import components
from slowtide.session import materialize, ship

SHINGLE = 3
SEED = 42
BUDGET = 2
SUBTREE = 1024
STEP = 4
#: The trie down to this depth has at most 2 ** BASE nodes, few enough to broadcast.
BASE = 16
CHUNK = 4 << 20
PAIRS = 1 << 17


def fingerprint(text: bytes, lower: bool = False) -> int:
    words = (text.lower() if lower else text).split()  # lower() of bytes folds A-Z only
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - SHINGLE + 1
    parts = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)
    ones = np.add.reduce(np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(n, 64), axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), lower: bool = False) -> DataFrame:
    """The columns in `keep` and the fingerprint, as a signed bigint, of every row."""
    ship(docs.sparkSession)
    source = docs.select(*dict.fromkeys([*keep, text]))
    kept = list(keep)

    def rows(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            for a, b in chunks(offsets, CHUNK):
                whole, ends = data[offsets[a] : offsets[b]].tobytes(), (offsets[a : b + 1] - offsets[a]).tolist()
                found = np.fromiter((fingerprint(whole[i:j], lower) for i, j in zip(ends[:-1], ends[1:], strict=True)), np.uint64, b - a)
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(a, b - a) for k in kept], pa.array(found.view(np.int64))], names=[*kept, "print"])

    return source.mapInArrow(rows, source.select(*kept).schema.add("print", "long"))


def _prefix(value: Column | str, depth: int | Column) -> Column:
    """The first `depth` bits, right-aligned; a shift by 64 would be none, hence two shifts."""
    rest = F.lit(64) - depth if isinstance(depth, Column) else F.lit(64 - depth)
    half = F.floor(rest / 2).cast("int")
    value = F.col(value) if isinstance(value, str) else value
    return F.call_function("shiftrightunsigned", F.call_function("shiftrightunsigned", value, half), (rest - half).cast("int"))


def _cut(prints: DataFrame, most: int) -> DataFrame:
    """(print, depth): the depth of the subtree each distinct fingerprint falls in."""
    base = prints.select("print", _prefix("print", BASE).alias("top"))
    counts = base.groupBy("top").agg(F.count("*").alias(f"n{BASE}"))
    for depth in range(BASE - STEP, -1, -STEP):
        above = counts.groupBy(F.shiftright("top", BASE - depth).alias("above")).agg(F.sum(f"n{BASE}").alias(f"n{depth}"))
        counts = counts.join(F.broadcast(above), F.shiftright("top", BASE - depth) == F.col("above")).drop("above")
    depth = F.coalesce(*[F.when(F.col(f"n{d}") <= most, F.lit(d)) for d in range(0, BASE + 1, STEP)])
    cut = materialize(base.join(F.broadcast(counts.select("top", depth.alias("depth"))), "top").select("print", "depth"), "cut")
    done, rest = cut.filter("depth is not null"), cut.filter("depth is null").select("print")
    for d in range(BASE + STEP, 65, STEP):
        if rest.isEmpty():
            break
        node = _prefix("print", d)
        sizes = materialize(rest.groupBy(node.alias("node")).count(), "sizes")
        cut = materialize(
            rest.join(sizes, node == F.col("node")).select("print", F.when((F.col("count") <= most) | F.lit(d == 64), F.lit(d)).alias("depth")), "cut"
        )
        done, rest = done.union(cut.filter("depth is not null")), cut.filter("depth is null").select("print")
    return done


def _subtree_pairs(leaves: DataFrame) -> DataFrame:
    """Pairs (a, a_depth, b, b_depth) of different subtrees whose paths differ in at most `BUDGET` bits.

    `leaves` has one row (node, depth) per subtree.
    """
    nodes = materialize(
        leaves.select("node", "depth", F.explode(F.sequence(F.lit(0), "depth", F.lit(STEP))).alias("at"))
        .select(F.call_function("shiftrightunsigned", "node", (F.col("depth") - F.col("at")).cast("int")).alias("node"), "at", "depth")
        .withColumn("node", F.when(F.col("depth") - F.col("at") == 64, F.lit(0).cast("bigint")).otherwise(F.col("node")))
        .select("node", "at", (F.col("at") < F.col("depth")).alias("open"))
        .distinct(),
        "nodes",
    )
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    front = nodes.filter("at = 0").select(
        F.col("node").alias("a"), F.col("at").alias("a_depth"), F.col("open").alias("a_open"), F.col("node").alias("b"), F.col("at").alias("b_depth"), F.col("open").alias("b_open"), F.lit(0).alias("differ")
    )
    found = []
    for depth in range(0, deepest, STEP):
        kids = nodes.filter(F.col("at") == depth + STEP).select(F.shiftrightunsigned("node", STEP).alias("parent"), F.col("node").alias("kid"), F.col("open").alias("kid_open"))
        grown = front.filter("a_open or b_open")
        for side in "ab":
            at = {c: F.col(f"{side}{c}") for c in ("", "_depth", "_open")}
            grown = grown.join(kids, F.when(at["_open"], at[""]) == F.col("parent"), "left").select(
                *[c for c in grown.columns if c[0] != side or c[1:] not in ("", "_depth", "_open")],
                F.coalesce("kid", at[""]).alias(f"{side}_new"), at["_open"].alias(f"{side}_was"), at[""].alias(f"{side}_old"), at["_depth"].alias(f"{side}_at"), F.coalesce("kid_open", F.lit(False)).alias(f"{side}_next"),
            )
        both = F.col("a_was") & F.col("b_was")
        differ = F.col("differ") + F.when(both, F.bit_count(F.col("a_new").bitwiseXOR(F.col("b_new")).bitwiseAND(F.lit((1 << STEP) - 1)))).otherwise(0)
        same = both & (F.col("a_old") == F.col("b_old"))
        front = materialize(
            grown.filter(~same | (F.col("a_new") <= F.col("b_new")))
            .select(
                F.col("a_new").alias("a"), F.when(F.col("a_was"), depth + STEP).otherwise(F.col("a_at")).alias("a_depth"), F.col("a_next").alias("a_open"),
                F.col("b_new").alias("b"), F.when(F.col("b_was"), depth + STEP).otherwise(F.col("b_at")).alias("b_depth"), F.col("b_next").alias("b_open"),
                differ.cast("int").alias("differ"),
            )
            .filter(F.col("differ") <= BUDGET),
            "front",
        )
        found.append(front.filter("not a_open and not b_open and not (a = b and a_depth = b_depth)").select("a", "a_depth", "b", "b_depth"))
    if not found:
        return front.filter("false").select("a", "a_depth", "b", "b_depth")
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


def _settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the sets of i and j; `label` holds the least index of each set, and does so again at the end."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def walk(prints: np.ndarray, label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Walk pairs of tries together and merge the labels of prints that differ in at most `BUDGET` bits.

    `prints` holds sorted stretches of unsigned fingerprints; rows of `a` and `b` are the [start, stop) of
    the two stretches of a pair. A trie node is a stretch, too.
    """
    todo = [(0, a[:, 0], a[:, 1], b[:, 0], b[:, 1], np.zeros(len(a), np.int64))]
    while todo:
        depth, alo, ahi, blo, bhi, differ = todo.pop()
        if len(alo) > PAIRS:
            half = len(alo) // 2
            todo += [(depth, alo[s], ahi[s], blo[s], bhi[s], differ[s]) for s in (slice(half, None), slice(half))]
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = np.bitwise_count(prints[i] ^ prints[j]) <= BUDGET
            _settle(label, i[near], j[near])
            alo, ahi, blo, bhi, differ = (x[~single] for x in (alo, ahi, blo, bhi, differ))
        if not len(alo):
            continue
        if depth == 64:  # equal prints do not repeat in a stretch
            continue
        bit = np.uint64(1) << np.uint64(63 - depth)
        amid, bmid = _split(prints, alo, ahi, bit), _split(prints, blo, bhi, bit)
        grown = []
        for x, (al, ah) in enumerate(((alo, amid), (amid, ahi))):
            for y, (bl, bh) in enumerate(((blo, bmid), (bmid, bhi))):
                more = differ + (x != y)
                on = (ah > al) & (bh > bl) & (more <= BUDGET)
                grown.append((al[on], ah[on], bl[on], bh[on], more[on]))
        todo.append((depth + 1, *[np.concatenate(x) for x in zip(*grown, strict=True)]))


def _split(prints: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """The first place in each sorted stretch whose print has the bit; the bits above it are equal."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        on = np.flatnonzero(lo < hi)
        if not len(on):
            return lo
        mid = (lo[on] + hi[on]) // 2
        up = (prints[mid] & bit) != 0
        hi[on[up]] = mid[up]
        lo[on[~up]] = mid[~up] + 1


def _inside(batches):
    """Sorted prints of each subtree, and for each the place of the first one of its component in there."""
    for batch in batches:
        packs = batch.column("prints")
        ends = np.concatenate([[0], np.cumsum(packs.value_lengths().to_numpy())]).astype(np.int64)
        prints = packs.flatten().to_numpy().view(np.uint64).copy()
        for i, j in zip(ends[:-1], ends[1:], strict=True):
            prints[i:j].sort()
        label = np.arange(len(prints))
        both = np.stack([ends[:-1], ends[1:]], axis=1)
        walk(prints, label, both, both)
        local = (label - np.repeat(ends[:-1], np.diff(ends))).astype(np.int32)
        at = pa.array(ends.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("depth"), pa.ListArray.from_arrays(at, pa.array(prints.view(np.int64))), pa.ListArray.from_arrays(at, pa.array(local))],
            names=["node", "depth", "prints", "first"],
        )


def _across(batches):
    """A spanning forest between the components of the two subtrees of each pair."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            prints, label, stretch, base = [], [], {}, 0
            for side in "ab":
                packs, firsts = part.column(f"{side}_prints"), part.column(f"{side}_first")
                sizes = packs.value_lengths().to_numpy().astype(np.int64)
                ends = base + np.concatenate([[0], np.cumsum(sizes)])
                prints.append(packs.flatten().to_numpy().view(np.uint64))
                label.append(firsts.flatten().to_numpy().astype(np.int64) + np.repeat(ends[:-1], sizes))
                stretch[side] = np.stack([ends[:-1], ends[1:]], axis=1)
                base = ends[-1]
            prints, before = np.concatenate(prints), np.concatenate(label)
            after = before.copy()
            walk(prints, after, stretch["a"], stretch["b"])
            moved = np.flatnonzero((before == np.arange(len(before))) & (after != before))
            yield pa.RecordBatch.from_arrays([pa.array(prints[moved].view(np.int64)), pa.array(prints[after[moved]].view(np.int64))], names=["a", "b"])


def links(prints: DataFrame, most: int = SUBTREE) -> DataFrame:
    """Links (a, b) whose components are those of all fingerprints within `BUDGET` bits.

    `prints` is a table of distinct fingerprints in the column print.
    """
    cut = _cut(prints, most)
    node = F.when(F.col("depth") == 0, F.lit(0).cast("bigint")).otherwise(_prefix("print", F.col("depth")))
    packs = materialize(
        cut.groupBy(node.alias("node"), "depth").agg(F.collect_list("print").alias("prints")).mapInArrow(_inside, "node long, depth int, prints array<long>, first array<int>"),
        "subtrees",
    )
    inner = packs.select(F.explode(F.arrays_zip("prints", F.transform("first", lambda k: F.element_at("prints", k + 1)).alias("head"))).alias("x"))
    inner = inner.select(F.col("x.prints").alias("a"), F.col("x.head").alias("b")).filter("a <> b")
    pairs = _subtree_pairs(packs.select("node", "depth"))
    for side in "ab":
        pack = packs.select(F.col("node").alias(side), F.col("depth").alias(f"{side}_depth"), F.col("prints").alias(f"{side}_prints"), F.col("first").alias(f"{side}_first"))
        pairs = pairs.join(pack, [side, f"{side}_depth"])
    return inner.union(pairs.select("a_prints", "a_first", "b_prints", "b_first").mapInArrow(_across, "a long, b long"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lower: bool = False) -> DataFrame:
    """(doc_id, text_hash, print, root, component_id, first) of every row.

    `root` names the component; `first` is its first row as (no id, doc_id, text_hash), ids before none.
    """
    marked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    rows = materialize(fingerprints(marked, keep=("doc_id", "text_hash"), lower=lower), "prints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    firsts = materialize(rows.groupBy("print").agg(least.alias("first")), "firsts")
    roots = components(links(firsts.select("print")))
    named = materialize(firsts.join(roots, firsts["print"] == roots["node"], "left").select("print", "first", F.coalesce("root", "print").alias("root")), "roots")
    heads = materialize(named.groupBy("root").agg(F.min("first").alias("first")), "heads")
    classes = materialize(named.select("print", "root").join(heads, "root"), "classes")
    return rows.join(classes, "print").select("doc_id", "text_hash", "print", "root", F.col("first.doc_id").alias("component_id"), "first")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lower: bool = False, near=None) -> DataFrame:
    """The rows of `docs`, all columns, without all but the first row of each component.

    `near(docs, text, doc_id)` names the components, by default `near_duplicates`.
    """
    plain, at = numbered(docs)
    found = near(plain, at[text], at[doc_id]) if near else near_duplicates(plain, at[text], at[doc_id], lower)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    kept = found.filter(F.col("first") == first).select(
        F.col("doc_id").isNull().alias("no_id__"), F.coalesce("doc_id", F.lit(0)).alias("id__"), F.col("text_hash").alias("hash__")
    )
    kept = kept.distinct()
    key = ["no_id__", "id__", "hash__"]
    # equal rows share a key; a task sends on one of them at most (the filter on the number is applied before the shuffle)
    one = Window.partitionBy(*key).orderBy(F.lit(1))
    keyed = plain.select(
        "*", F.col(at[doc_id]).isNull().alias("no_id__"), F.coalesce(at[doc_id], F.lit(0)).alias("id__"), F.xxhash64(at[text]).alias("hash__")
    )
    rows = keyed.withColumn("turn__", F.row_number().over(one)).filter("turn__ = 1").join(kept, key, "left_semi")
    return rows.drop(*key, "turn__").toDF(*docs.columns)


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text"), lower=True)
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
