"""The wide-budget trie join against brute force, in every layout; near copies against exact Jaccard; awkward rows."""

import random

import numpy as np
import plain
import pytest
import xxhash
from pyspark.sql import functions as F

from slowtide.llm import nearcopies as nc
from slowtide.llm.components import components
from slowtide.llm.simhash import one_of_each


def plain_print(text):
    hashes = sorted(
        (xxhash.xxh3_128_digest(s, 42) + xxhash.xxh3_128_digest(s, 43) for s in plain.shingle_set(text))
    )
    if not hashes:
        return [0] * 4
    values = [int.from_bytes(h, "big") for h in hashes]
    out = 0
    for bit in range(256):
        ones = sum(v >> bit & 1 for v in values)
        if 2 * ones > len(values) or 2 * ones == len(values) and values[0] >> bit & 1:
            out |= 1 << bit
    return [out >> 64 * (3 - k) & (1 << 64) - 1 for k in range(4)]


def test_fingerprint():
    rng = random.Random(3)
    long = " ".join(str(rng.randrange(300)) for _ in range(nc.BLOCK + 700))
    for text in ("", " \n\t ", "One", "one two three four", "a b c d e f", "x y " * 50, "Ä B c d e f g", long):
        assert nc.fingerprint(text.encode()).tolist() == plain_print(text), text[:20]


@pytest.fixture(scope="module")
def prints():
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2, (60, 256), dtype=np.uint8)
    near = bits[rng.integers(0, 12, 240)] ^ (rng.random((240, 256)) < rng.uniform(0.02, 0.16, (240, 1))).astype(np.uint8)
    chain = [bits[0]]
    for _ in range(10):
        chain.append(chain[-1] ^ (rng.random(256) < 0.1).astype(np.uint8))
    return np.packbits(np.concatenate([bits, near, chain[1:]]), axis=1).view(">u8").astype(np.uint64)


def brute_force(prints):
    """The least place of each print's component."""
    heads = [nc._heads(prints, 2 * t) for t in range(nc.TRIES)]
    root = list(range(len(prints)))
    while True:
        before = list(root)
        for i in range(len(prints)):
            near = np.bitwise_count(prints[i] ^ prints).sum(axis=1) <= nc.BUDGETS[-1]
            met = np.any([np.bitwise_count(h[i] ^ h) <= nc.HEAD_BUDGET for h in heads], axis=0)
            for j in np.flatnonzero(near & met):
                root[i] = root[j] = min(root[i], root[j])
        if root == before:
            return root


@pytest.mark.parametrize("most", [1 << 18, 100, 20])
def test_links_in_any_layout(spark, prints, most):
    signed = prints.view(np.int64)
    table = spark.createDataFrame([(k, *map(int, row)) for k, row in enumerate(signed)], "node long, p0 long, p1 long, p2 long, p3 long")
    found = nc.links(table, most)
    assert all(r["a"] < r["b"] for r in found.collect())
    got = {r["node"]: r["root"] for r in components(found).collect()}
    want = brute_force(prints)
    assert [got.get(k, k) for k in range(len(prints))] == want
    assert len(set(want)) < len(prints) - 100


def test_heads_are_the_rotated_bits(spark, prints):
    signed = prints[:20].view(np.int64)
    table = spark.createDataFrame([tuple(map(int, row)) for row in signed], "p0 long, p1 long, p2 long, p3 long")
    got = table.select(*[nc._head(o).alias(f"t{o}") for o in range(2 * nc.TRIES)]).collect()
    for row, words in zip(got, prints[:20].tolist(), strict=True):
        whole = "".join(f"{w:064b}" for w in words)
        for t in range(nc.TRIES):
            head = (whole[16 * t :] + whole)[: nc.HEAD]
            assert row[2 * t] == int(head, 2) and row[2 * t + 1] == int(head[nc.HEAD // 2 :] + head[: nc.HEAD // 2], 2)
    for o in range(2 * nc.TRIES):
        assert nc._heads(prints[:20], o).tolist() == [r[o] for r in got]


def edited(rng, words, share):
    return [f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_near_copies_are_found_and_clean_texts_left(spark):
    rng = random.Random(11)
    texts = {}
    for base in range(0, 400, 8):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(150, 500))]
        for k in range(4):  # J from about 0.9 up
            texts[base + k] = " ".join(words if not k else edited(rng, words, 0.004 * k))
        texts[base + 4] = " ".join(words[: len(words) // 2])  # half of it: below 0.8
        texts[base + 5] = " ".join(words).upper()
        texts[base + 6] = " ".join(edited(rng, words, 0.2))
        texts[base + 7] = " ".join(rng.sample(words, len(words)))
    want = plain.similar_groups(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in nc.near_copies(docs).collect()}
    linked = [i for i in want if want[i] != i]
    assert sum(got[i] == want[i] for i in linked) >= 0.97 * len(linked)
    assert all(want[i] == want[got[i]] for i in got)  # no link that brute force has not
    assert {r["doc_id"] for r in one_of_each(docs, near=nc.near_copies).collect()} == {i for i in got if got[i] == i}


def test_awkward_rows(spark):
    long = " ".join(f"v{k % 7000}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "two words"), (5, "TWO  words"), (5, "two words"), (None, "two words"), (None, None), (6, long), (7, long + " tail"), (8, "words two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("NODE", F.lit(1)).withColumn("first", F.lit("x"))
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in nc.near_copies(docs).collect())
    assert got == [(-1, 1), (-1, 4), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (6, 6), (7, 6), (8, 8)]
    kept = one_of_each(docs, near=nc.near_copies)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 6, 8]
    assert nc.near_copies(docs.filter("false")).count() == 0
    twice = docs.union(docs)
    assert sorted(r["doc_id"] for r in one_of_each(twice, near=nc.near_copies).collect()) == [1, 4, 6, 8]
