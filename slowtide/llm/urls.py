"""URL filter: host and path rules, and gradient-boosted trees on lexical features for all other URLs.

URLs that a rule decides are the labelled ones. The trees learn from at most `SAMPLE` distinct ones, chosen by the hash
of the URL within each class, and judge every URL without a rule. Features: lengths of URL, host and path, depth, host
labels, share of digits, character entropy, number of parameters, a fragment flag, and statistics of the host's suffix
(its last two labels): how often it is met among all labelled URLs and its smoothed share of blocked ones. For a training
row, the fold (by the hash of the URL) that it is in is left out of them, so no row sees its own label.

Everything is Spark SQL and MLlib. The suffix table grows with the input and is joined without a hint.

Edge cases: a null URL, or one without `://`, has an empty host and path, no rule, and is judged on its
features; with one class or no labelled URL there is nothing to learn, and the verdict is that class (`allow` for
none). Repeated rows are judged alike, each on its own row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import pick
from slowtide.session import materialize

#: Fixed values: (verdict, host, path) of the rules.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
SAMPLE = 20_000
TREES = 20
DEPTH = 3
#: Rows learn from the suffix statistics of the folds they are not in.
FOLDS = 5
#: Weight of the overall share in a suffix's share.
PRIOR = 20.0

FEATURES = ["n_chars", "n_host", "n_path", "depth", "n_labels", "digit_ratio", "entropy", "n_params", "has_fragment", "suffix_seen", "suffix_blocked"]


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host in lower case (A-Z only), path, and what follows the path; all empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url__, instr(url__, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return (
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        F.regexp_extract(rest, r"(?s)^[^?#]*(.*)$", 1),
    )


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits, or null."""
    names, verdicts = [], []
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        names.append(F.when(fits, F.lit(h + p)))
        verdicts.append(F.when(fits, F.lit(verdict)))
    return F.coalesce(*names), F.coalesce(*verdicts)


def entropy(text: Column) -> Column:
    """Bits per character, from run lengths of the sorted characters."""

    def closed(acc):
        return acc["total"] + F.when(acc["run"] > 0, acc["run"] * F.log2(acc["run"])).otherwise(0.0)

    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))

    def step(acc, c):
        same = acc["last"] == c
        return F.struct(
            c.alias("last"),
            F.when(same, acc["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
            F.when(same, acc["total"]).otherwise(closed(acc)).alias("total"),
        )

    summed = F.aggregate(F.array_sort(F.split(text, "")), start, step, closed)
    size = F.length(text)
    return F.when(size > 0, F.log2(size.cast("double")) - summed / size).otherwise(0.0)


def described(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule and its verdict, and the lexical features but those of the suffix."""
    base = pick(pages, "page_id", "url").select("page_id", F.coalesce("url", F.lit("")).alias("url__"))
    host, path, tail = parts(F.col("url__"))
    base = base.select("page_id", "url__", host.alias("host"), path.alias("path"), tail.alias("tail__"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    url, query = F.col("url__"), F.regexp_extract("tail__", r"^\?([^#]*)", 1)
    size = F.length(url)
    return base.select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
        F.xxhash64("url__").alias("url_hash"),
        F.substring_index("host", ".", -2).alias("suffix"),
        size.cast("double").alias("n_chars"),
        F.length("host").cast("double").alias("n_host"),
        F.length("path").cast("double").alias("n_path"),
        F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double").alias("depth"),
        F.size(F.split("host", r"\.")).cast("double").alias("n_labels"),
        F.when(size > 0, F.length(F.regexp_replace(url, r"[^0-9]", "")) / size).otherwise(0.0).alias("digit_ratio"),
        entropy(url).alias("entropy"),
        F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double").alias("n_params"),
        F.when(F.instr("tail__", "#") > 0, 1.0).otherwise(0.0).alias("has_fragment"),
    )


def suffix_counts(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(suffix, seen, blocked) over all labelled rows, and the same by fold of the URL."""
    by_fold = materialize(labelled.groupBy("suffix", "fold").agg(F.count("*").alias("seen"), F.sum("label").alias("blocked")), "suffixes")
    return by_fold.groupBy("suffix").agg(F.sum("seen").alias("seen__"), F.sum("blocked").alias("blocked__")), by_fold


def _with_suffix(rows: DataFrame, suffixes: DataFrame, share: float, without: DataFrame | None = None) -> DataFrame:
    """Adds the statistics of the suffix; those of the row's own fold, `without`, are left out."""
    joined = rows.join(suffixes, "suffix", "left")
    seen, blocked = F.coalesce("seen__", F.lit(0)), F.coalesce("blocked__", F.lit(0.0))
    if without is not None:
        own = without.select("suffix", "fold", F.col("seen").alias("own_seen__"), F.col("blocked").alias("own_blocked__"))
        joined = joined.join(own, ["suffix", "fold"], "left")
        seen, blocked = seen - F.coalesce("own_seen__", F.lit(0)), blocked - F.coalesce("own_blocked__", F.lit(0.0))
    return joined.select(*rows.columns, F.log1p(seen).alias("suffix_seen"), ((blocked + PRIOR * share) / (seen + PRIOR)).alias("suffix_blocked"))


def training_sample(labelled: DataFrame, most: int) -> tuple[DataFrame, int, int]:
    """At most `most` distinct labelled URLs by their hash, half of them of each class if there are so many; rows of each class."""
    distinct = labelled.drop("page_id", "host", "path", "rule", "ruled").distinct()
    picked = [materialize(distinct.filter(F.col("label") == c).orderBy("url_hash").limit(most), "urls") for c in (0, 1)]
    n = [p.count() for p in picked]
    sizes = [min(n[c], max(most // 2, most - n[1 - c])) for c in (0, 1)]
    return picked[0].orderBy("url_hash").limit(sizes[0]).union(picked[1].orderBy("url_hash").limit(sizes[1])), sizes[0], sizes[1]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, most: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the trees' probability of `block`) of every page."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = described(pages, rules)
    labelled = rows.filter("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    labelled = labelled.withColumn("fold", F.pmod(F.shiftright("url_hash", 7), F.lit(FOLDS)))
    suffixes, by_fold = suffix_counts(labelled)
    totals = by_fold.agg(F.sum("seen"), F.sum("blocked")).first()
    n, blocked = totals[0] or 0, totals[1] or 0
    columns = ["page_id", "host", "path", "rule"]
    if blocked in (0, n):
        only = "block" if n and blocked == n else "allow"
        return rows.select(*columns, F.coalesce("ruled", F.lit(only)).alias("verdict"), F.lit(float(only == "block")).alias("score"))
    share = blocked / n
    sample, n_allow, n_block = training_sample(labelled, most)
    taught = _with_suffix(sample, suffixes, share, by_fold)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # both classes weigh the same, so that a rare one is not simply outvoted
    both = n_allow + n_block
    taught = taught.withColumn("weight", F.when(F.col("label") == 1, 0.5 * both / n_block).otherwise(0.5 * both / n_allow))
    trees = GBTClassifier(weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7).fit(vectors.transform(taught))
    scored = trees.transform(vectors.transform(_with_suffix(rows, suffixes, share)))
    score = vector_to_array("probability")[1]
    return scored.select(*columns, F.coalesce("ruled", F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"), score.alias("score"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
