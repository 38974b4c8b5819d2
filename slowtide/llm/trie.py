"""Prefix trie of conversations, built by van Emde Boas recursion over the depth.

A turn is a digest of its role and text. Sequences of turns are cut at half depth: the upper part up to the cut, the
lower part below it. The cut prefix gets a name, the upper parts form the upper trie, the lower parts one forest under
each name, and both are built in the same way. All parts of one recursion level are in one frame, so they are built in
parallel, and each level halves the number of rows on its way up and doubles it on its way down:

- Within a band of `BAND` turns the recursion runs on the at most `BAND` digests of one conversation (`prefixes`).
- Across bands it runs in Spark (`halves`): blocks of 1, 2, 4, .. bands get names from their two halves, and from the
  top downwards the lower half of each block gets the name of the prefix that ends at the cut.

A node is the group of rows (conversation, depth) with one name. Its smallest member owns it, and then owns all deeper
nodes of its own sequence: a branch that hangs on one node of another owner. Totals are grafted upwards along the same
cuts: what a branch holds below a cut is added to the blocks above it, which gives the branch's total from any of its
depths on, and each branch's total is then added to every node on its owner's sequence, which are its ancestors.

Scale: texts are reduced to digests while they are scanned and never shuffled. Turns are numbered over range slices,
so a conversation that holds a third of all rows spreads over many tasks, as do its bands. Popular nodes (the root, a
common first turn) are counted by partial aggregation; rows that must meet a popular node are met by joins that adaptive
execution splits. The ids of a node's ending members are joined to chunks of at most `IDS` before the chunks of one node
meet in one task, which streams them (SHA-256 is a chain).

Edge cases: null roles and texts are empty. Rows of one turn go by the digest of role and text; equal rows are turns of
their own. Rows without a conv_id take no part. A conversation with nothing left is a member of the root only. Without
any conversation there is no node. Names and digests have 128 bits. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from slowtide.llm.common import pick
from slowtide.operators import ordered
from slowtide.session import materialize, ship

#: log2 of the turns of a band.
BAND_BITS = 5
BAND = 1 << BAND_BITS
IDS = 1024
MOST_SHARED = 6
TOP = b"\0" * 16


def named(*parts: Column) -> Column:
    """The name of what its parts name, as `name_of` gives it."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def name_of(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:16]


def prefixes(turns: list[bytes]) -> list[bytes]:
    """Names of all prefixes: those of the upper half, and those of the lower half under the name of the cut prefix."""
    if len(turns) == 1:
        return turns
    half = 1 << ((len(turns) - 1).bit_length() - 1)
    upper, lower = prefixes(turns[:half]), prefixes(turns[half:])
    return upper + [name_of(upper[-1], x) for x in lower]


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), turn (digest), chars of every turn in order."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").filter("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = named(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    slim = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("at"), digest.alias("turn"), F.char_length(text).cast("long").alias("chars"))
    # equal rows may lie in different slices
    salted = slim.withColumn("salt", F.monotonically_increasing_id())
    placed = ordered.positions(salted, ["conv_id"], [F.col("at").asc_nulls_first(), F.col("turn"), F.col("salt")], "depth")
    return placed.select("conv_id", "depth", "turn", "chars")


def rebuilt(turns: DataFrame, group: int = 100, shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Sequences that begin like the first conversation of their group of ids, and (conv_id, size) of all of them.

    The first crc32(conv_id) % `shared` turns come from conversation conv_id - conv_id % `group`.
    """
    turns = materialize(turns, "sequences")
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    cut = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    told = counts.select("conv_id", "n", cut.alias("cut"), (F.col("conv_id") - F.col("conv_id") % group).alias("donor"))
    given = counts.select(F.col("conv_id").alias("donor"), F.col("n").alias("given"))
    taken = F.least("cut", F.coalesce("given", F.lit(0)))
    size = taken + F.greatest(F.col("n") - F.col("cut"), F.lit(0))
    sized = materialize(told.join(given, "donor", "left").select("conv_id", "donor", "cut", taken.alias("taken"), size.alias("size")), "sizes")
    own = turns.join(sized.select("conv_id", "cut", "taken", "size"), "conv_id").filter("depth > cut")
    own = own.select("conv_id", (F.col("depth") - F.col("cut") + F.col("taken")).alias("depth"), "turn", "chars", "size")
    first = turns.filter((F.col("conv_id") % group == 0) & (F.col("depth") < shared)).withColumnRenamed("conv_id", "donor")
    head = first.join(sized, "donor").filter("depth <= cut").select("conv_id", "depth", "turn", "chars", "size")
    return own.union(head), sized.select("conv_id", "size")


def halves(blocks: DataFrame, whole, to_left, to_right, start: Column) -> DataFrame:
    """(conv_id, block, value): recursion by halves over the numbered blocks (conv_id, block, whole) of each sequence.

    Upwards, `whole(left, right)` joins the two halves of each larger block (right is null where there is none).
    Downwards, the value of the topmost block is `start`, and a block hands `to_left(value, left, right)` and
    `to_right(value, left, right)` to its halves.
    """
    levels, now = [], blocks
    while (now.agg(F.max("block")).first()[0] or 0) > 0:
        odd = F.col("block") % 2 == 1
        pairs = now.groupBy("conv_id", F.shiftright("block", 1).alias("pair")).agg(F.max(F.when(~odd, F.col("whole"))).alias("left"), F.max(F.when(odd, F.col("whole"))).alias("right"), F.max(odd).alias("two"))
        pairs = materialize(pairs.select("conv_id", F.col("pair").alias("block"), "left", "right", "two", whole(F.col("left"), F.col("right")).alias("whole")), "halves")
        levels.append(pairs)
        now = pairs.select("conv_id", "block", "whole")
    values = now.select("conv_id", "block", start.alias("value"))
    for pairs in reversed(levels):
        met = values.join(pairs.drop("whole"), ["conv_id", "block"])
        args = F.col("value"), F.col("left"), F.col("right")
        children = F.array(F.struct((F.col("block") * 2).alias("block"), to_left(*args).alias("value")), F.when(F.col("two"), F.struct((F.col("block") * 2 + 1).alias("block"), to_right(*args).alias("value"))))
        values = materialize(met.select("conv_id", F.explode(F.filter(children, lambda c: c.isNotNull())).alias("c")).select("conv_id", "c.block", "c.value"), "halves")
    return values


def _spanning(bands: DataFrame) -> DataFrame:
    """Bands of the sequences that have several; the others need no recursion across bands."""
    several = bands.filter("block > 0").select("conv_id").distinct()
    return bands.join(several, "conv_id", "left_semi")


def members(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(name, depth, conv_id, size, chars, turn) for every prefix of every sequence, the empty one included."""
    ship(turns.sparkSession)
    # at most BAND rows a group
    listed = turns.groupBy("conv_id", F.shiftright(F.col("depth") - 1, BAND_BITS).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "turn", "chars"))).alias("rows"), F.max("size").alias("size")
    )

    def local(batches):
        for batch in batches:
            found = [prefixes(t) for t in batch.column("turns").to_pylist()]
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.binary()))], names=[*batch.schema.names, "names"])

    flat = listed.select("conv_id", "block", "size", F.col("rows.depth").alias("depths"), F.col("rows.turn").alias("turns"), F.col("rows.chars").alias("chars"))
    bands = materialize(flat.mapInArrow(local, StructType([*flat.schema, StructField("names", ArrayType(BinaryType()))])), "bands")
    whole = F.when(F.size("names") == BAND, F.element_at("names", -1))
    blocks = materialize(_spanning(bands.select("conv_id", "block", whole.alias("whole"))), "blocks")
    roots = halves(blocks, named, lambda v, left, right: v, lambda v, left, right: named(v, left), F.lit(TOP)).filter("block > 0")
    under = bands.join(roots.withColumnRenamed("value", "root"), ["conv_id", "block"], "left")
    each = under.select("conv_id", "size", F.coalesce("root", F.lit(TOP)).alias("root"), F.explode(F.arrays_zip("depths", "turns", "chars", "names")).alias("x"))
    inner = each.select(named("root", F.col("x.names")).alias("name"), F.col("x.depths").alias("depth"), "conv_id", "size", F.col("x.chars").alias("chars"), F.col("x.turns").alias("turn"))
    outer = sizes.select(F.lit(TOP).alias("name"), F.lit(0).cast("long").alias("depth"), "conv_id", "size", F.lit(0).cast("long").alias("chars"), F.lit(None).cast("binary").alias("turn"))
    return inner.union(outer)


def _endings(rows: DataFrame) -> DataFrame:
    """(name, ends_sha256): the hash of the ids of the members that end at a node, ascending and comma-joined."""

    def chunks(batches):
        name, ids = None, []

        def close():
            return pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], names=["name", "first", "ids"])

        for batch in batches:
            for n, c in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (n != name or len(ids) >= IDS):
                    yield close()
                    ids = []
                name = n
                ids.append(c)
        if ids:
            yield close()

    def hashed(batches):
        name, state = None, None
        for batch in batches:
            names, found = [], []
            for n, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if n != name:
                    if name is not None:
                        names.append(name)
                        found.append(state.hexdigest())
                    name, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], names=["name", "ends_sha256"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], names=["name", "ends_sha256"])

    ends = rows.filter("depth = size").select("name", "conv_id").repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    joined = ends.mapInArrow(chunks, "name binary, first long, ids string")
    return joined.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashed, "name binary, ends_sha256 string")


def _downward(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, leaves_on, saved_on): totals of a branch from each of its depths on."""
    placed = nodes.select("conv_id", "depth", F.shiftright("depth", BAND_BITS).alias("block"), F.struct((F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")).alias("own"))
    added = lambda a, b: F.struct((a["leaves"] + F.coalesce(b["leaves"], F.lit(0))).alias("leaves"), (a["saved"] + F.coalesce(b["saved"], F.lit(0))).alias("saved"))
    none = F.struct(F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    sums = placed.groupBy("conv_id", "block").agg(F.sum("own.leaves").alias("leaves"), F.sum("own.saved").alias("saved")).select("conv_id", "block", F.struct("leaves", "saved").alias("whole"))
    blocks = materialize(_spanning(sums), "blocks")
    # a branch may begin in a later band, so that the left half is missing
    below = halves(
        blocks, lambda left, right: added(F.coalesce(left, none), right), lambda v, left, right: added(v, right), lambda v, left, right: v, none
    ).withColumnRenamed("value", "below")
    after = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc())
    met = placed.join(below, ["conv_id", "block"], "left").withColumn("below", F.coalesce("below", none))
    return met.select("conv_id", "depth", (F.sum("own.leaves").over(after) + F.col("below.leaves")).alias("leaves_on"), (F.sum("own.saved").over(after) + F.col("below.saved")).alias("saved_on"))


def trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per node: conv_id (its owner), depth, turn (digest; null for the root), parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 (see `op13_prefix_trie`)."""
    rows = materialize(members(turns, sizes), "members")
    owner = F.min(F.struct("conv_id", "size")).alias("owner")
    nodes = rows.groupBy("name").agg(owner, F.first("depth").alias("depth"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"), F.first("turn").alias("turn"))
    nodes = materialize(nodes.select("name", "owner.conv_id", "owner.size", "depth", "n_convs", "chars", "turn"), "nodes")
    branches = nodes.groupBy("conv_id").agg(F.min("depth").alias("depth")).filter("depth > 0")
    held = branches.withColumn("above", F.col("depth") - 1).join(rows.select("conv_id", F.col("depth").alias("above"), "name"), ["conv_id", "above"])
    holders = nodes.select("name", F.col("conv_id").alias("parent_conv_id"))
    hung = materialize(held.join(holders, "name").select("conv_id", "depth", "above", "parent_conv_id"), "branches")
    others = hung.groupBy(F.col("parent_conv_id").alias("conv_id"), F.col("above").alias("depth")).agg(F.count("*").alias("others"))
    on = (F.col("size") > F.col("depth")).cast("long")
    known = nodes.join(others, ["conv_id", "depth"], "left").join(hung.drop("above"), ["conv_id", "depth"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    known = known.select("name", "conv_id", "depth", "turn", "n_convs", "chars", (on + F.coalesce("others", F.lit(0))).alias("n_children"), parent.alias("parent_conv_id"))
    known = materialize(known, "nodes")
    downward = materialize(_downward(known), "downward")
    # a branch's total is that from its first depth on
    branch = downward.groupBy("conv_id").agg(F.max("leaves_on").alias("leaves"), F.max("saved_on").alias("saved"))
    grafted = rows.select("name", "conv_id").join(branch, "conv_id").groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    full = known.join(downward, ["conv_id", "depth"]).join(branch.select("conv_id", F.col("leaves").alias("own_leaves"), F.col("saved").alias("own_saved")), "conv_id")
    full = full.join(grafted, "name").join(_endings(rows), "name", "left")
    return full.select(
        "conv_id", "depth", "turn", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaves") - F.col("own_leaves") + F.col("leaves_on")).alias("n_leaves"), (F.col("saved") - F.col("own_saved") + F.col("saved_on")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Adds role and text of each node's last turn."""
    rows = pick(conversations, "conv_id", "role", "text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = named(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    known = rows.select(digest.alias("turn"), role.alias("role"), text.alias("text")).dropDuplicates(["turn"])
    return nodes.join(known, "turn", "left")


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns, sizes = rebuilt(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return trie(turns, sizes).drop("turn")
