"""The training sample of the URL filter against copies of one hot URL, and suffix statistics over all labelled URLs."""

from pyspark.sql import functions as F

from slowtide.llm import urls


def test_a_hot_url_does_not_fill_the_sample(spark):
    long_path = "/en/" + "deep/" * 12
    rows = [(i, f"http://h{i}.example.com{long_path}{i}?s={i}") for i in range(100)] + [(1000 + i, f"http://h{i}.example.com/de/{i}") for i in range(100)]
    unknown = [(5000 + i, f"http://h{i}.example.org{long_path}{i}?s={i}") for i in range(30)] + [(6000 + i, f"http://h{i}.example.org/de/{i}") for i in range(30)]
    frame = spark.createDataFrame(rows + unknown, "page_id long, url string").coalesce(1)
    hot = frame.filter("page_id < 2000").orderBy(F.xxhash64("url")).first()["url"]
    copies = spark.createDataFrame([(2000 + i, hot) for i in range(200)], frame.schema)
    got = {r["page_id"]: r["verdict"] for r in urls.judge(frame.union(copies).coalesce(1), most=100).collect()}
    assert sum(got[5000 + i] == "block" for i in range(30)) > 25 and sum(got[6000 + i] == "allow" for i in range(30)) > 25
