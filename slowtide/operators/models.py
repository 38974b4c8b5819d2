"""Fitting: scaling, the slow-probability model, and quantile regression of log time."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.functions.scorer import Scorer
from slowtide.operators.metrics import TAU, pos_weight
from slowtide.operators.ordered import quantiles
from slowtide.operators.perceptron import mean_loss, minimise
from slowtide.session import materialize


# rows of one task of a fit that reads its rows many times: fewer are not worth a task, more are too many for one
LEAST_ROWS, MOST_ROWS = 100_000, 1_000_000
# equal rows, on average, from which the perceptron's fit reads each once with their number
REPEATS = 100


def spread(df: DataFrame, rows: int) -> DataFrame:
    """`df`, which has about so many rows, dealt over the cores, at most about `MOST_ROWS` to a task.

    A file of few row groups is read by as few tasks, and each pass of a fit would run in these.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(-(-rows // LEAST_ROWS), 3 * cores), -(-rows // MOST_ROWS))
    return df.repartition(tasks) if tasks > 1 else df


def fit_scale(train: DataFrame, features: Sequence[str]) -> tuple[list[float], list[float]]:
    """Mean and population deviation per feature; a constant feature has scale 1."""
    row = train.agg(*[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_pop(f).alias(f"s_{f}") for f in features]).first()
    return [float(row[f"m_{f}"]) for f in features], [float(row[f"s_{f}"]) or 1.0 for f in features]


def standardise(df: DataFrame, features: Sequence[str], train: DataFrame) -> DataFrame:
    """Each feature as (x - mean) / population deviation of the training rows, in one plan."""
    fitted = train.agg(*[F.struct(F.avg(f).alias("mean"), F.stddev_pop(f).alias("scale")).alias(f) for f in features])
    known = df.withColumn("fit__", fitted.select(F.struct(*features)).scalar())
    scaled = {}
    for f in features:
        spread = F.col(f"fit__.{f}.scale")
        scaled[f] = (F.col(f) - F.col(f"fit__.{f}.mean")) / F.when(spread == 0, 1.0).otherwise(spread)
    return known.withColumns(scaled).drop("fit__")


def targets(df: DataFrame) -> DataFrame:
    """`y_slow` (1 for slow) and `y_log` (log1p of the warm time)."""
    return df.withColumns(
        {"y_slow": (F.col("label") == "slow").cast("double"), "y_log": F.log1p("execution_time_warm_ms")}
    )


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def fit_slow_model(df: DataFrame, features: Sequence[str], label: str = "y_slow", max_iter: int = 50):
    """Weighted logistic regression; slow rows weigh fast/slow."""
    weight = pos_weight(df, label).first()["pos_weight"]
    weighted = df.withColumn("weight__", F.when(F.col(label) == 1, float(weight)).otherwise(1.0))
    return LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="weight__", standardization=False, regParam=1e-6, maxIter=max_iter
    ).fit(assemble(weighted, features))


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Rows in which both classes count alike: rows of the rarer class are repeated, none is dropped.

    A row is repeated by the whole part of the ratio, and once more for a share of the rows (by their
    hash) that makes up for the rest; the result has at most twice the rows of the larger class.
    With a single class nothing is repeated.
    """
    counts = pos_weight(df, label).first()
    fewer, more = sorted((counts["slow"], counts["fast"]))
    ratio = more / fewer if fewer else 1.0
    rare = F.col(label) == (1 if counts["slow"] <= counts["fast"] else 0)
    rest = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) < int((ratio - int(ratio)) * (1 << 20))
    times = F.when(rare, F.lit(int(ratio)) + rest.cast("int")).otherwise(1)
    return df.withColumn("again__", F.explode(F.array_repeat(F.lit(1), times))).drop("again__")


def fit_perceptron(df: DataFrame, features: Sequence[str], label: str = "y_slow", max_iter: int = 60, seed: int = 42):
    """The layered variant of the slow-probability model, on standardised features and balanced classes.

    The fitted model takes rows with the features as they are. A pass of MLlib's trainer, which knows no weights, reads
    every row. Where equal rows are many, the passes read each once and count it as often as it comes: the same
    network, start, loss and solver, so their time goes by the number of different rows.
    """
    net = MultilayerPerceptronClassifier(
        featuresCol="scaled", labelCol=label, layers=[len(features), 64, 32, 16, 2], maxIter=max_iter, seed=seed
    )
    scaling = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
    ]
    rows = balanced(df.select(*features, label), label)
    counted = rows.groupBy(*features, label).agg(F.count("*").alias("rows__"))
    total, different = counted.agg(F.coalesce(F.sum("rows__"), F.lit(0)), F.count("*")).first()
    if not different or total < REPEATS * different:
        return Pipeline(stages=[*scaling, net]).fit(spread(rows, total))
    scale, once = Pipeline(stages=scaling).fit(rows), materialize(counted, "perceptron")
    means, deviations = (v.toArray() for v in (scale.stages[1].mean, scale.stages[1].std))
    factors = np.divide(1, deviations, out=np.zeros_like(deviations), where=deviations != 0)
    scaled = scale.transform(once)
    # MLlib draws the first weights and checks the rows
    start = net.copy({net.maxIter: 0}).fit(scaled).weights.toArray()
    numbers = once.select(*[F.col(x).cast("double") for x in (*features, label, "rows__")])
    weights = minimise(mean_loss(numbers, net.getLayers(), means, factors), start, max_iter, net.getTol())
    return PipelineModel([*scale.stages, net.copy({net.maxIter: 0, net.initialWeights: Vectors.dense(weights)}).fit(scaled)])


def _linear(features: Sequence[str], weights: Sequence[float], bias: float) -> Column:
    out = F.lit(float(bias))
    for name, w in zip(features, weights, strict=True):
        out = out + F.col(name) * F.lit(float(w))
    return out


def fit_quantile(
    df: DataFrame,
    features: Sequence[str],
    target: str = "y_log",
    tau: float = TAU,
    steps: int = 12,
    tolerance: float = 5e-3,
    most_steps: int = 40,
) -> tuple[list[float], float]:
    """Linear quantile regression: weights and intercept that make the pinball loss small.

    Repeated weighted least squares, one pass over the rows each: a row weighs its pinball slope
    over the size of its last error, so the weighted squares approach the pinball loss. After `steps`
    passes the fit goes on until `quantile_slopes` are below `tolerance`, at most `most_steps` in all.
    A pass is one aggregate of the moments of the standardised features and of the slopes.
    At the end the intercept becomes the exact quantile of what the weights leave over, which is its best
    value. Only coefficients come to the driver.
    """
    kept = materialize(df.select(*features, target), "quantile")
    weights, bias = [0.0] * len(features), 0.0
    if features:
        known = [~F.isnan(F.coalesce(F.col(x).cast("double"), F.lit(math.nan))) for x in (*features, target)]
        bad = kept.agg(*[F.count_if(~k) for k in known]).first()
        if any(bad):
            raise ValueError(f"features and target must not be null or NaN: {dict(zip((*features, target), bad))}")
        ends = fit_scale(kept, features)
        for step in range(most_steps):
            gap = F.col(target) - _linear(features, weights, bias)
            slope = F.when(gap >= 0, tau).otherwise(1 - tau)
            weight = slope / F.greatest(F.abs(gap), F.lit(max(1e-4, 0.5**step))) if step else F.lit(1.0)
            # a pass gives the next fit and, from `steps` on, how far this one is from its optimum
            left = _slopes(features, weights, bias, target, tau, [F.lit(m) for m in ends[0]], [F.lit(s) for s in ends[1]]) if step >= steps else []
            sums = kept.agg(*_moments(features, target, weight, *ends), *left).first()
            if left and max(sums[-len(left) :]) < tolerance:
                break
            last, (weights, bias) = weights, _solve(sums, features, *ends)
            moved = max(abs(a - b) for a, b in zip(last, weights))
            if step and moved < 1e-6:
                break
    left = kept.select((F.col(target) - _linear(features, weights, 0.0)).alias("left"))
    return weights, float(quantiles(left, [], "left", {"q": tau}).first()["q"])


def _moments(features: Sequence[str], target: str, weight: Column, means: Sequence[float], scales: Sequence[float]) -> list[Column]:
    """Weighted sums of the products of 1, the standardised features and the target, upper triangle by rows."""
    terms = [F.lit(1.0), *[(F.col(f) - F.lit(m)) / F.lit(s) for f, m, s in zip(features, means, scales)], F.col(target)]
    return [F.sum(weight * terms[i] * terms[j]).alias(f"s{i}_{j}") for i in range(len(terms)) for j in range(i, len(terms))]


def _solve(sums: Sequence[float], features: Sequence[str], means: Sequence[float], scales: Sequence[float]) -> tuple[list[float], float]:
    """Weights and intercept of the least squares whose `_moments` are given; a feature that the others give has the least weight."""
    n = len(features) + 2
    whole = np.zeros((n, n))
    whole[np.triu_indices(n)] = sums[: n * (n + 1) // 2]
    whole = np.triu(whole) + np.triu(whole, 1).T
    b = np.linalg.lstsq(whole[:-1, :-1], whole[:-1, -1], rcond=1e-12)[0]
    weights = b[1:] / np.array(scales)
    return [float(w) for w in weights], float(b[0] - weights @ np.array(means))


def _slopes(features: Sequence[str], weights: Sequence[float], bias: float, target: str, tau: float, means: Sequence[Column], scales: Sequence[Column]) -> list[Column]:
    gap = F.col(target) - _linear(features, weights, bias)
    met = F.abs(gap) < 1e-9

    def least(x: Column) -> Column:
        fixed = F.avg(F.when(met, 0.0).when(gap > 0, tau * x).otherwise((tau - 1) * x))
        # the ties reach from `low` to `high`; what they cannot cancel is left
        low = F.avg(F.when(met, F.least(tau * x, (tau - 1) * x)).otherwise(0.0))
        high = F.avg(F.when(met, F.greatest(tau * x, (tau - 1) * x)).otherwise(0.0))
        return F.greatest(fixed + low, -(fixed + high), F.lit(0.0))

    return [least(F.lit(1.0)).alias("intercept"), *[least((F.col(f) - m) / s).alias(f) for f, m, s in zip(features, means, scales)]]


def quantile_slopes(
    df: DataFrame, features: Sequence[str], weights: Sequence[float], bias: float, target: str = "y_log", tau: float = TAU
) -> DataFrame:
    """How far a quantile fit is from its optimum: one row, `intercept` and one column per feature.

    At the minimum of the pinball loss zero is among its slopes in every direction. A column holds the
    least absolute mean slope, the feature taken as (x - mean) / deviation; a row that is met exactly
    may have any slope between tau - 1 and tau. All columns are zero at an exact optimum.
    """
    known = df
    if features:
        ends = df.agg(*[F.struct(F.avg(f).alias("mean"), F.stddev_pop(f).alias("scale")).alias(f) for f in features])
        known = df.withColumn("fit__", ends.select(F.struct(*features)).scalar())
    spreads = [F.col(f"fit__.{f}.scale") for f in features]
    return known.agg(*_slopes(features, weights, bias, target, tau, [F.col(f"fit__.{f}.mean") for f in features], [F.when(s == 0, 1.0).otherwise(s) for s in spreads]))


def fit_scorer(train: DataFrame, features: Sequence[str], steps: int = 12) -> Scorer:
    """Both heads on standardised features; `train` has `y_slow` and `y_log`."""
    means, scales = fit_scale(train, features)
    scaled = train.select(
        *[((F.col(f) - F.lit(m)) / F.lit(s)).alias(f) for f, m, s in zip(features, means, scales)], "y_slow", "y_log"
    )
    slow = fit_slow_model(scaled, features)
    log_weights, log_bias = fit_quantile(scaled, features, steps=steps)
    return Scorer(
        list(features), means, scales, [float(w) for w in slow.coefficients], float(slow.intercept), log_weights, log_bias
    )


def fit_squared(df: DataFrame, features: Sequence[str], target: str = "y_log", seed: int = 42, depth: int = 4):
    """The squared-error variant of the log-time model."""
    rows = df.select(*features, target)
    return GBTRegressor(featuresCol="features", labelCol=target, maxIter=10, maxDepth=depth, seed=seed).fit(assemble(spread(rows, df.count()), features))
