"""Pairwise quality ranking: features, optimum, threshold and held-out accuracy."""

import re
import zlib

import numpy as np
import plain
import pytest

from slowtide.llm import ranking
from slowtide.llm.common import pick, text_bytes


def plain_features(text):
    """The features of one text, by their definitions."""
    raw = (text or "").encode()
    size = max(1, len(raw))
    share = lambda of: (sum(b in of for b in raw) / size) ** 0.5
    out = dict.fromkeys(ranking.FEATURES, 0.0)
    out |= {"symbols": share(b"#*$%&|<>"), "upper": share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": share(b"0123456789"), "stops": share(b".!?"), "letters": share(b"abcdefghijklmnopqrstuvwxyz"), "other_bytes": share(range(128, 256))}
    words = [w.encode() for w in plain.words(text)]
    lines = [x for x in (text or "").split("\n") if plain.words(x)]
    if words:
        n = len(words)
        out["words"], out["distinct"] = np.log1p(n), len(set(words)) / n
        out["same_neighbour"] = (sum(words[i] == words[i + 1] for i in range(n - 1)) / n) ** 0.5
        out["repeated_lines"] = (1 - len(set(lines)) / len(lines)) ** 0.5
        out["word_length"], out["line_words"] = np.log(sum(map(len, words)) / n), np.log1p(n / len(lines))
    return [out[f] for f in ranking.FEATURES]


def described(docs):
    return ranking.describe(pick(docs, "doc_id", "text"))


def test_features(spark):
    rows = pick(plain.edge_docs(spark), "text").union(pick(plain.documents(spark), "text")).toArrow()
    got = ranking.features(*text_bytes(rows.column("text")))
    assert np.allclose(got, [plain_features(t) for t in rows.column("text").to_pylist()])


def test_weights_are_the_optimum():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0.5, 1, (60, 4)), rng.normal(-0.5, 1, (45, 4))
    w = ranking.bradley_terry(good, bad, rivals=45)
    turn = np.arange(60)
    diffs = np.concatenate([good - bad[(turn + 2 * k) % 45] for k in range(45)])
    # the gradient of the penalised logistic loss vanishes
    p = 1 / (1 + np.exp(diffs @ w))
    assert np.abs(-(diffs.T @ p) / len(diffs) + ranking.RIDGE * w).max() < 1e-8
    assert ((good @ w)[:, None] > bad @ w).mean() > 0.8


def test_quantile():
    counts = np.zeros(ranking.BINS, np.int64)
    counts[[10, 20, 40]] = 5, 3, 2
    at = lambda k: (np.array([10, 20, 40]) + 0.5 - ranking.BINS // 2) * ranking.BIN > ranking.quantile(counts, k)
    assert at(5).tolist() == [False, True, True] and at(8).tolist() == [False, False, True] and at(0).tolist() == [True, True, True]
    assert at(10).tolist() == [False, False, False]
    assert at(6).tolist() == [False, True, True]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in ranking.op11_pairwise_quality(spark, folder).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for d, r in rows.items())
    unseen = [(rows[d]["predicted"], q) for d, q in labels.items() if rows[d]["held_out"]]
    assert np.mean([p == q for p, q in unseen]) >= 0.97


def test_held_out_labels_do_not_matter(spark):
    docs, labels = plain.documents(spark), plain.documents(spark, "labels")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    a, b = ranking.fit(described(docs), labels), ranking.fit(described(docs), turned)
    assert np.array_equal(a.weights, b.weights) and a.threshold == b.threshold


@pytest.mark.parametrize("which", ["none", "one label", "no documents"])
def test_without_preferences(spark, which):
    docs, labels = plain.edge_docs(spark), plain.documents(spark, "labels")
    labels = labels.filter("false" if which == "none" else "quality = 1" if which == "one label" else "true")
    ranker = ranking.fit(described(docs.filter("false") if which == "no documents" else plain.documents(spark)), labels)
    assert {(r["score"], r["predicted"]) for r in ranking.rank(described(docs), ranker).collect()} == {(0.5, 1)}


def test_edge_rows(spark):
    docs = plain.edge_docs(spark)
    ranker = ranking.fit(described(plain.documents(spark)), plain.documents(spark, "labels"))
    got = ranking.rank(described(docs), ranker)
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == docs.count()
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert not re.search("nan", str(got.collect()))
    # contradictory, null and repeated labels
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (4, 1, None), (4, 1, None), (6, 0, 0), (7, 0, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(ranking.fit(described(docs), odd).weights) in (0, len(ranking.FEATURES))
