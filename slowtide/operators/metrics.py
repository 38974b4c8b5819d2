"""Model metrics and summaries of feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.functions.numeric import log10_floor
from slowtide.operators.ordered import quantiles, running_sums

# Weight of the classification loss and the quantile of the regression loss.
ALPHA, TAU = 0.6, 0.7


def pinball(target: Column, predicted: Column, tau: float = TAU) -> Column:
    gap = target - predicted
    return F.greatest(gap * tau, gap * (tau - 1))


def joint_loss(df: DataFrame, label: str, logit: str, target: str, predicted: str, pos_weight: Column) -> DataFrame:
    """ALPHA * weighted cross-entropy on logits + (1 - ALPHA) * pinball, each a mean over rows."""
    y, z = F.col(label), F.col(logit)
    # log(1 + exp(-z)) without overflow
    soft = F.log1p(F.exp(-F.abs(z))) + F.greatest(-z, F.lit(0.0))
    weight = (pos_weight - 1) * y + 1
    bce = F.avg((1 - y) * z + weight * soft)
    quantile = F.avg(pinball(F.col(target), F.col(predicted)))
    return df.agg(bce.alias("bce"), quantile.alias("qloss"), (bce * ALPHA + quantile * (1 - ALPHA)).alias("loss"))


def pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Fast rows per slow row; at least one slow row is assumed."""
    slow = F.count_if(F.col(label) == 1)
    fast = F.count_if(F.col(label) == 0)
    return df.agg(slow.alias("slow"), fast.alias("fast"), (fast / F.greatest(slow, F.lit(1))).alias("pos_weight"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The four cells, also those without rows."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counts = df.agg(*[F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"n{a}{p}") for a, p in cells])
    rows = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n{a}{p}").alias("n")) for a, p in cells]
    return counts.select(F.inline(F.array(*rows)))


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support for each class, macro and weighted means, and accuracy."""
    one = df.agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(actual) == k).alias(f"a{k}") for k in (0, 1)],
        *[F.count_if(F.col(predicted) == k).alias(f"p{k}") for k in (0, 1)],
        *[F.count_if((F.col(actual) == k) & (F.col(predicted) == k)).alias(f"h{k}") for k in (0, 1)],
    )
    n = F.col("n")

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    def score(k):
        precision, recall = ratio(F.col(f"h{k}"), F.col(f"p{k}")), ratio(F.col(f"h{k}"), F.col(f"a{k}"))
        return precision, recall, ratio(precision * recall * 2, precision + recall), F.col(f"a{k}")

    fast, slow = score(0), score(1)
    macro = [(x + y) / 2 for x, y in zip(fast[:3], slow[:3])]
    weighted = [ratio(x * fast[3] + y * slow[3], n) for x, y in zip(fast[:3], slow[:3])]
    accuracy = ratio(F.col("h0") + F.col("h1"), n)
    lines = [
        ("fast", *fast), ("slow", *slow), ("macro avg", *macro, n), ("weighted avg", *weighted, n),
        ("accuracy", accuracy, accuracy, accuracy, n),
    ]
    names = ("class", "precision", "recall", "f1", "support")
    rows = [F.struct(F.lit(v[0]).alias(names[0]), *[x.alias(k) for x, k in zip(v[1:], names[1:])]) for v in lines]
    return one.select(F.inline(F.array(*rows)))


def _steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives at each distinct score, and down to it from the highest."""
    at = df.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return running_sums(at, [], [F.col(score).desc()], {"pos_to": F.col("pos"), "neg_to": F.col("neg")})


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at every distinct threshold."""
    steps = _steps(df, label, score)
    totals = df.agg(F.struct(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))).scalar()
    return steps.withColumn("all__", totals).select(
        F.col(score).alias("threshold"),
        F.try_divide(F.col("neg_to").cast("double"), F.col("all__.n")).alias("fpr"),
        F.try_divide(F.col("pos_to").cast("double"), F.col("all__.p")).alias("tpr"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    steps = _steps(df, label, score)
    won = F.sum(F.col("neg") * (F.col("pos_to") - F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return steps.agg(F.try_divide(won.cast("double"), pairs).alias("auc"))


def regression_metrics(df: DataFrame, true_log: str, predicted_log: str) -> DataFrame:
    """MAE in log space and in ms, and R2 in log space (1 - SSE/SST)."""
    t, p = F.col(true_log), F.col(predicted_log)
    sst = F.var_pop(t) * F.count(t)
    return df.agg(
        F.avg(F.abs(p - t)).alias("log_mae"),
        F.avg(F.abs(F.expm1(p) - F.expm1(t))).alias("ms_mae"),
        (1 - F.try_divide(F.sum((t - p) * (t - p)), sst)).alias("r2"),
    )


def residuals(df: DataFrame, true_log: str, predicted_log: str) -> DataFrame:
    return df.withColumn("residual", F.col(predicted_log) - F.col(true_log))


def residual_summary(df: DataFrame, true_log: str, predicted_log: str) -> DataFrame:
    return residuals(df, true_log, predicted_log).agg(
        F.avg("residual").alias("mean"), F.stddev_pop("residual").alias("std"), F.min("residual").alias("min"), F.max("residual").alias("max")
    )


def top_correlations(df: DataFrame, features: Sequence[str], target: Column, n: int = 5) -> DataFrame:
    """Pearson correlation of every feature with the target from one pass, strongest first.

    A constant feature has no correlation and is left out.
    """
    base = df.select(*[F.col(f).cast("double").alias(f) for f in features], target.alias("target__"))
    spread = F.stddev_pop("target__")
    one = base.agg(
        *[F.try_divide(F.covar_pop(f, "target__"), F.stddev_pop(f) * spread).alias(f) for f in features]
    )
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("correlation")) for f in features]
    return (
        one.select(F.inline(F.array(*rows)))
        .filter("correlation IS NOT NULL")
        .orderBy(F.abs("correlation").desc(), "feature")
        .limit(n)
    )


def class_balance(df: DataFrame) -> DataFrame:
    slow = F.count_if(F.col("label") == "slow")
    return df.agg(
        F.count("*").alias("total"),
        slow.alias("slow"),
        F.count_if(F.col("label") == "fast").alias("fast"),
        (F.try_divide(slow, F.count("*")) * 100).alias("slow_pct"),
        F.count_if(F.col("timed_out_runs") > 0).alias("timed_out"),
    )


def mean_time_by_class(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.avg("execution_time_warm_ms").alias("mean_ms"))


def log_histogram(df: DataFrame, key: str, value: str, bins: int = 40, floor: float = 0.05) -> DataFrame:
    """Counts of log10(value) in equal bins between each key's own least and largest value.

    The last bin includes its right edge; a key with one value uses a range of width one around it.
    """
    logged = df.select(F.col(key).alias("key__"), log10_floor(F.col(value), floor).alias("x"))
    # one row a key; the values themselves are only counted, by bin, before anything is shuffled
    ends = logged.groupBy(F.col("key__").alias("end_key__")).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    place = F.when(flat, F.lit(0.5)).otherwise((F.col("x") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)))
    bin_of = F.least(F.floor(place * bins) + 1, F.lit(bins)).cast("int")
    met = logged.join(ends, F.col("key__") == F.col("end_key__"))
    return met.groupBy(F.col("key__").alias(key), bin_of.alias("bin")).agg(F.count("*").alias("n"))


def low_cardinality_means(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Class means of the features with at most two distinct values or a maximum of at most 10.

    At most two distinct values means that none lies strictly between least and largest, which
    needs no distinct counting.
    """
    ends = df.agg(*[F.struct(F.min(f).alias("lo"), F.max(f).alias("hi")).alias(f) for f in features])
    # one row of 2 * len(features) numbers
    known = df.withColumn("ends__", ends.select(F.struct(*features)).scalar())
    between = {
        f: F.count_if((F.col(f) > F.col(f"ends__.{f}.lo")) & (F.col(f) < F.col(f"ends__.{f}.hi"))) for f in features
    }
    grouped = known.groupBy(label).agg(
        *[
            F.struct(
                F.avg(f).alias("mean"), between[f].alias("between"), F.max(f"ends__.{f}.hi").cast("double").alias("hi")
            ).alias(f)
            for f in features
        ]
    )
    rows = [
        F.struct(F.lit(f).alias("feature"), F.col(f"{f}.mean").alias("mean"), F.col(f"{f}.between").alias("between"), F.col(f"{f}.hi").alias("hi"))
        for f in features
    ]
    long = grouped.select(label, F.inline(F.array(*rows)))
    inside = F.sum("between").over(Window.partitionBy("feature"))
    return long.withColumn("inside__", inside).filter("inside__ = 0 OR hi <= 10").select(label, "feature", "mean")


def box_summary(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Quartiles of log10(feature), values below 1 raised to 1, per feature and class."""
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), log10_floor(F.col(f).cast("double"), 1.0).alias("x")) for f in features])
    long = df.select(key, F.inline(rows))
    return quantiles(long, ["feature", key], "x", {"q1": 0.25, "median": 0.5, "q3": 0.75})


def worst_errors(df: DataFrame, actual: str, predicted: str, p_slow: str, ident: str, n: int = 5) -> DataFrame:
    """The n false positives with the highest and false negatives with the lowest p_slow."""
    kind = F.when(F.col(actual) < F.col(predicted), "false_positive").when(F.col(actual) > F.col(predicted), "false_negative")
    doubt = F.when(F.col("error") == "false_positive", -F.col(p_slow)).otherwise(F.col(p_slow))
    order = Window.partitionBy("error").orderBy("doubt__", ident)
    wrong = df.withColumn("error", kind).filter("error IS NOT NULL").withColumn("doubt__", doubt)
    return wrong.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).drop("doubt__")


def best_epoch(histories: DataFrame, run: str, epoch: str, loss: str) -> DataFrame:
    """The epoch with the lowest loss of each run, the first one on ties."""
    return histories.groupBy(run).agg(
        F.min_by(epoch, F.struct(loss, epoch)).alias("best_epoch"), F.min(loss).alias("best_loss")
    )
