"""Near copies at 5-word shingles: several binary tries joined with themselves.

At a shingle Jaccard of 0.8 SimHash bits differ in about 15 of 100 places, too many for one trie over 64 bits.
Here a text has a 256-bit fingerprint of its distinct 5-word shingles (A-Z, and no other letters, in lower case),
and trie t of `TRIES` reads those bits from bit 16 t on, round to the start. Each trie is joined with itself: node pairs are
walked together, differing bits add up, and a pair is dropped beyond `HEAD_BUDGET` of the first `HEAD` bits and beyond
the last of `BUDGETS` of all 256; a pair at 0.8 survives in some trie with a probability of about 0.95. The exact Jaccard of
the surviving links is then taken over whole texts, and links below 0.8 go.

With at most one differing bit, one half of the first `HEAD` bits is equal. So each trie stands twice, once from either half
on, and only subtrees under the same path of at most 10 bits need to meet: 32 rows a fingerprint, whatever their number.
A subtree of more than `SUBTREE` fingerprints (many near copies, or over 200 million texts) is dealt out in parts that
all meet. The cut is a matter of layout: the same pairs survive at every depth. A subtree (or pair of parts) emits a spanning forest of pairs that survived,
the closest first (one pass a budget), never all of them; its ends are compared exactly. In a large group a text whose only
partner at 0.8 lies beside closer-looking ones below 0.8 may so stay apart, unless another trie joins the two.

Edge cases: equal fingerprints (exact copies, however many) are one node from the start. A null or empty text has
fingerprint zero, linked with its like only; fewer than five words make one shingle. Ids, repeated rows, empty tables and
extra columns are treated as in `simhash.near_duplicates`.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import chunks, text_bytes
from slowtide.llm.components import components
from slowtide.llm.simhash import CHUNK, PAIRS, _split
from slowtide.session import materialize, ship

SHINGLE = 5
SEEDS = (42, 43)
TRIES = 16
HEAD = 20
HEAD_BUDGET = 1
BUDGETS = (34, 40, 46)
SUBTREE = 1 << 18
#: Fingerprints a subtree aimed at; fewer, deeper subtrees only cost more calls.
AIM = 1 << 12
#: Shingles hashed, and summed, at a time.
BLOCK = 1 << 14
WORDS = [f"p{k}" for k in range(4)]


def shingles_of(text: bytes) -> np.ndarray:
    """Hashes, four words each, of the distinct shingles, in ascending order."""
    words = text.lower().split()  # lower() of bytes folds A-Z only
    if not words:
        return np.zeros((0, 4), ">u8")
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    hashes = np.empty((n, 4), ">u8")
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + width - 1]
        shingles = list(map(b" ".join, zip(*(part[k:] for k in range(width)), strict=False)))
        for half, seed in enumerate(SEEDS):
            digests = b"".join(map(xxhash.xxh3_128_digest, shingles, repeat(seed)))
            hashes[at : at + BLOCK, 2 * half : 2 * half + 2] = np.frombuffer(digests, ">u8").reshape(-1, 2)
    return hashes[np.unique(hashes[:, 0], return_index=True)[1]]


def fingerprint(text: bytes) -> np.ndarray:
    """Four unsigned words; a bit is set in more than half of the hashes, on a tie as in the smallest."""
    hashes = shingles_of(text)
    if not len(hashes):
        return np.zeros(4, np.uint64)
    ones = np.zeros(256, np.int64)
    for at in range(0, len(hashes), BLOCK):
        ones += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8), axis=1).sum(axis=0, dtype=np.uint32)
    least = np.unpackbits(hashes[:1].view(np.uint8))
    bits = 2 * ones + least > len(hashes)
    return np.packbits(bits).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, p0 .. p3) of rows (doc_id, text, text_hash); `node` is a hash of the four words."""
    ship(docs.sparkSession)

    def rows(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets, CHUNK):
                whole, ends = data[offsets[a] : offsets[b]].tobytes(), (offsets[a : b + 1] - offsets[a]).tolist()
                found = np.array([fingerprint(whole[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)], np.uint64).reshape(-1, 4)
                kept = [batch.column(k).slice(a, b - a) for k in ("doc_id", "text_hash")]
                columns = [pa.array(np.ascontiguousarray(found[:, k]).view(np.int64)) for k in range(4)]
                yield pa.RecordBatch.from_arrays(kept + columns, names=["doc_id", "text_hash", *WORDS])

    schema = docs.select("doc_id", "text_hash").schema
    for name in WORDS:
        schema = schema.add(name, "long")
    out = docs.select("doc_id", "text_hash", "text").mapInArrow(rows, schema)
    return out.select("doc_id", "text_hash", F.xxhash64(*WORDS).alias("node"), *WORDS)


def _heads(prints: np.ndarray, order: int) -> np.ndarray:
    """The first `HEAD` bits of each fingerprint in the order of trie order // 2, from its second half on if odd."""
    trie = order // 2

    def piece(k: int) -> np.ndarray:
        return (prints[:, k // 4] >> np.uint64(48 - 16 * (k % 4))) & np.uint64(0xFFFF)

    head = (piece(trie) << np.uint64(4)) | (piece((trie + 1) % 16) >> np.uint64(12))
    half = np.uint64(HEAD // 2)
    return (head & np.uint64((1 << HEAD // 2) - 1)) << half | head >> half if order % 2 else head


def _head(order: int):
    trie = order // 2

    def piece(k: int):
        return F.shiftrightunsigned(f"p{k // 4}", 48 - 16 * (k % 4)).bitwiseAND(F.lit(0xFFFF))

    head = F.shiftleft(piece(trie), 4).bitwiseOR(F.shiftrightunsigned(piece((trie + 1) % 16), 12))
    swapped = F.shiftleft(head.bitwiseAND(F.lit((1 << HEAD // 2) - 1)), HEAD // 2).bitwiseOR(F.shiftright(head, HEAD // 2))
    return swapped if order % 2 else head


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Merge the sets of i and j; the pairs that joined two sets. `label` holds the least index of each set."""
    used = []
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return used
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        high, pick = np.unique(np.maximum(a, b), return_index=True)
        label[high] = np.minimum(a, b)[pick]
        used.append((i[pick], j[pick]))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _confirm(prints, label, a, b, budget: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Compare every print of each stretch of `a` with every one of its stretch of `b`, `PAIRS` at a time at most."""
    (alo, ahi), (blo, bhi), used = a, b, []
    step = np.maximum(1, PAIRS // np.maximum(1, bhi - blo))  # a long stretch is taken in pieces
    pieces = -(-(ahi - alo) // step)
    which = np.repeat(np.arange(len(alo)), pieces)
    start = alo[which] + (np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * step[which]
    stop, wide = np.minimum(start + step[which], ahi[which]), (bhi - blo)[which]
    ends, at = np.cumsum((stop - start) * wide), 0
    while at < len(which):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        sizes = ((stop - start) * wide)[at:to]
        row = np.repeat(np.arange(at, to), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        i, j = start[row] + place // wide[row], blo[which[row]] + place % wide[row]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        near = np.bitwise_count(prints[i] ^ prints[j]).sum(axis=1, dtype=np.int64) <= budget
        used += _merge(label, i[near], j[near])
        at = to
    return used


def walk(heads: np.ndarray, prints: np.ndarray, label: np.ndarray, a: tuple[int, int], b: tuple[int, int], budget: int) -> list:
    """Walk two tries, stretches [start, stop) of sorted heads, together; pairs that join the sets of `label`."""
    used = []
    todo = [(0, *(np.array([x], np.int64) for x in (*a, *b, 0)))]
    while todo:
        depth, alo, ahi, blo, bhi, differ = todo.pop()
        if len(alo) > PAIRS:
            half = len(alo) // 2
            todo += [(depth, *(x[s] for x in (alo, ahi, blo, bhi, differ))) for s in (slice(half, None), slice(half))]
            continue
        if depth == HEAD:
            used += _confirm(prints, label, (alo, ahi), (blo, bhi), budget)
            continue
        bit = np.uint64(1) << np.uint64(HEAD - 1 - depth)
        amid, bmid = _split(heads, alo, ahi, bit), _split(heads, blo, bhi, bit)
        same, grown = (alo == blo) & (ahi == bhi), []
        for x, (al, ah) in enumerate(((alo, amid), (amid, ahi))):
            for y, (bl, bh) in enumerate(((blo, bmid), (bmid, bhi))):
                more = differ + (x != y)
                on = (ah > al) & (bh > bl) & (more <= HEAD_BUDGET) & ~(same & (x > y))
                grown.append((al[on], ah[on], bl[on], bh[on], more[on]))
        grown = [np.concatenate(x) for x in zip(*grown, strict=True)]
        if len(grown[0]):
            todo.append((depth + 1, *grown))
    return used


def _forest(group: pa.Table) -> pa.Table:
    """Links between the fingerprints of one subtree, or of two parts of it."""
    prints = np.stack([group.column(n).to_numpy().view(np.uint64) for n in WORDS], axis=1)
    side, node = group.column("side").to_numpy(), group.column("node").to_numpy()
    heads = _heads(prints, int(group.column("order")[0].as_py()))
    order = np.lexsort((heads, side))
    heads, prints, side, node = heads[order], prints[order], side[order], node[order]
    cut, n = int(np.searchsorted(side, 1)), len(side)
    one = group.column("one")[0].as_py()
    sides = ((0, n), (0, n)) if one else ((0, cut), (cut, n))
    label, used = np.arange(n), []
    if one or 0 < cut < n:
        for budget in BUDGETS:
            used += walk(heads, prints, label, *sides, budget)
    found = [node[np.concatenate(x)] if used else node[:0] for x in (zip(*used, strict=True) if used else ((), ()))]
    return pa.table({"a": np.minimum(*found), "b": np.maximum(*found)})


def links(prints: DataFrame, most: int = SUBTREE) -> DataFrame:
    """Pairs (a, b) of nodes, a <= b, that survive the walk; `prints` has distinct (node, p0 .. p3)."""
    n, depth = prints.count(), 0
    while depth < HEAD // 2 and n > min(most, AIM) << depth:
        depth += 1
    tops = F.array(*[F.struct(F.lit(o).alias("order"), F.shiftright(_head(o), HEAD - depth).alias("top")) for o in range(2 * TRIES)])
    rows = prints.select("node", *WORDS, F.explode(tops).alias("at")).select("node", *WORDS, "at.order", "at.top")
    large = rows.groupBy("order", "top").count().filter(F.col("count") > most)
    large = materialize(large.select("order", "top", F.ceil(F.col("count") / most).alias("parts")), "sizes")
    met = rows.join(large, ["order", "top"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    met = met.withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    met = met.select("node", *WORDS, "order", "top", "part", every.alias("other"))
    met = met.select(
        "node", *WORDS, "order", "top", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"),
        (F.col("part") > F.col("other")).cast("int").alias("side"), (F.col("part") == F.col("other")).alias("one"),
    )
    return met.groupBy("order", "top", "first", "second").applyInArrow(_forest, "a long, b long")


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts have a shingle Jaccard of 0.8 or more; `texts` has (node, text), a node's rows alike."""
    ship(texts.sparkSession)

    def rows(batches):
        for batch in batches:
            once = np.unique(batch.column("node").to_numpy(), return_index=True)[1]
            batch = batch.take(pa.array(once))
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets, CHUNK):
                found = [shingles_of(data[offsets[k] : offsets[k + 1]].tobytes())[:, 0].astype(np.uint64).view(np.int64) for k in range(a, b)]
                ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(a, b - a), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found)))], names=["node", "shingles"]
                )

    sets = texts.select("node", "text").mapInArrow(rows, "node long, shingles array<long>")
    sets = materialize(sets.groupBy("node").agg(F.any_value("shingles").alias("shingles")), "sets")
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"of_{side}")), side)
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.filter(9 * shared >= 4 * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, node, root, component_id, first) of every row, as `simhash.near_duplicates` gives them."""
    marked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    rows = materialize(fingerprints(marked), "prints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    firsts = materialize(rows.groupBy("node").agg(least, *[F.min(p).alias(p) for p in WORDS]), "firsts")
    pairs = materialize(links(firsts.select("node", *WORDS)).distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("end")).union(pairs.select("b")).distinct()
    key = [F.col("first.no_id").alias("no_id"), F.coalesce("first.doc_id", F.lit(0)).alias("id"), F.col("first.text_hash").alias("hash")]
    wanted = firsts.join(ends, F.col("node") == F.col("end")).select("node", *key)
    keyed = marked.select("text", F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash"))
    roots = components(similar(pairs, keyed.join(wanted, ["no_id", "id", "hash"])))
    named = firsts.select("node", "first").join(roots.withColumnRenamed("node", "other"), F.col("node") == F.col("other"), "left")
    named = materialize(named.select("node", "first", F.coalesce("root", "node").alias("root")), "roots")
    heads = materialize(named.groupBy("root").agg(F.min("first").alias("first")), "heads")
    classes = materialize(named.select("node", "root").join(heads, "root"), "classes")
    return rows.select("doc_id", "text_hash", "node").join(classes, "node").select(
        "doc_id", "text_hash", "node", "root", F.col("first.doc_id").alias("component_id"), "first"
    )
