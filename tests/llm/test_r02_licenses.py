"""License notices of one family at different places of a text."""

from slowtide.llm import licenses


def test_notices_at_other_places_keep_their_labels(spark):
    two, three = (words for label, _, least, words in licenses.TEMPLATES if label in ("gpl-2", "gpl-3") and least == 0.8)
    changed = three.replace("redistribute", "share")
    by = next(words for label, _, _, words in licenses.TEMPLATES if label == "cc-by")
    texts = [two + " other words between them " * 5 + changed, two, three, by]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect()}
    assert [got[i]["labels"] for i in range(4)] == ["gpl-2,gpl-3", "gpl-2", "gpl-3", "cc-by"]
    assert got[0]["score"] == 1
