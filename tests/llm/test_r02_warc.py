"""Captures of pages without an id, against the check SQL."""

from slowtide.llm import warc


def test_pages_without_id_keep_two_captures(spark):
    pages = spark.createDataFrame([(None, "http://a.com/x", "h"), (1, "http://a.com/y", "i"), (2, "http://a.com/z", "j")], "page_id long, url string, html string")
    got = warc.captures_of(pages.coalesce(1)).collect()
    assert sorted(str(r["record_id"]) for r in got) == sorted(["None", "None", "4", "5", "6", "8", "9"])
