"""Cases of the second review: what the operators did only in part."""

import numpy as np
import plain
import pytest

import corpus_pipeline
from slowtide.llm import packing, simhash


def test_simhash_folds_a_to_z_only(spark, tmp_path):
    text = "The quick brown fox jumps over the lazy dog near the old river bank"
    rows = [(1, text), (2, text.upper()), (3, text.lower()), (4, "É " + text), (5, "é " + text)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.op4_simhash(spark, str(tmp_path)).collect()}
    assert got[1] == got[2] == got[3] == (plain.fingerprint(text.lower()), 1)
    assert got[4][0] == plain.fingerprint("É " + text.lower()) and got[5][0] == plain.fingerprint("é " + text.lower())
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows[:3], "doc_id long, text string"), str(tmp_path))
    assert [r["doc_id"] for r in kept.collect()] == [1]


@pytest.mark.parametrize("lengths", [(500, 600, 948), (500, 600, 940), (500, 600, 800)])
def test_hot_lengths_keep_their_pattern(lengths):
    counts = np.zeros(2049, np.int64)
    counts[list(lengths)] = 1000
    made = packing.plan(counts)
    assert sum(times for _, times in made) <= 1000
    used = np.zeros(2049, np.int64)
    for pattern, times in made:
        assert sum(pattern) <= 2048 and times > 0
        np.add.at(used, list(pattern), times)
    assert (used == counts).all()
