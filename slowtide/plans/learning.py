"""Statistics, model metrics, fitting and vector lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from slowtide.functions import numeric as N
from slowtide.functions.scorer import Scorer
from slowtide.operators import metrics as M
from slowtide.operators import models, vectors
from slowtide.operators import pairs as P
from slowtide.plans import fixtures as X
from slowtide.plans.fixtures import Log
from slowtide.plans.live import SQL_SIMILAR
from slowtide.plans.relational import r4
from slowtide.session import scratch_path

QUERIES: dict = {}
CHECKS: dict = {}

c = F.col
NUMBERS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_LINE_SQL = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"


def _add(name, build, sql=None):
    QUERIES[name] = lambda spark, folder: build(Log(spark, folder))
    if sql:
        CHECKS[name] = X.exact_rounding(sql)


def _labelled(t):
    """Every lineitem as one measured query: label and warm time from its price."""
    return t.lineitem.select(
        F.concat_ws("-", *LINE).alias("row_id"),
        *NUMBERS,
        F.lit(1).alias("l_constant"),
        "l_suppkey",
        c("l_extendedprice").alias("execution_time_warm_ms"),
        F.when(c("l_extendedprice") > 60000, "slow").otherwise("fast").alias("label"),
        F.when(c("l_tax") > 0.07, 1).otherwise(0).alias("timed_out_runs"),
    )


_LABELLED_SQL = f"""labelled AS (
  SELECT {_LINE_SQL} AS row_id, *, 1 AS l_constant, l_extendedprice AS ms, CASE WHEN l_extendedprice > 60000 THEN 'slow' ELSE 'fast' END AS label
  FROM lineitem)"""

_add(
    "m01_feature_matrix",
    lambda t: models.assemble(_labelled(t), NUMBERS).select(
        "row_id", F.array_join(F.transform(_vector_values("features"), lambda x: F.format_string("%.2f", x)), ",").alias("features")
    ),
    f"SELECT {_LINE_SQL} AS row_id, printf('%.2f,%.2f,%.2f,%.2f', l_quantity, l_discount, l_tax, CAST(l_linenumber AS DOUBLE)) AS features FROM lineitem",
)


def _vector_values(column):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(c(column))


_add(
    "m02_targets",
    lambda t: models.targets(_labelled(t)).select("row_id", "y_slow", r4(c("y_log"), "y_log")),
    f"WITH {_LABELLED_SQL} SELECT row_id, CAST(label = 'slow' AS DOUBLE) AS y_slow, round(ln(1 + ms), 4) AS y_log FROM labelled",
)
_add(
    "m03_stratified_split",
    lambda t: P.split_rows(t.labels, "doc_id", 42, 0.2, strata="quality").select("doc_id", "quality", "split"),
    """SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id)
         <= floor(count(*) OVER (PARTITION BY quality) * 0.2) THEN 'val' ELSE 'train' END AS split FROM labels""",
)
_SCALED = [*NUMBERS, "l_constant"]
_add(
    "m04_standardise",
    lambda t: models.standardise(_labelled(t), _SCALED, _labelled(t).filter("label = 'fast'")).select(
        "row_id", *[r4(c(f), f) for f in _SCALED]
    ),
    f"""WITH {_LABELLED_SQL}, train AS (SELECT * FROM labelled WHERE label = 'fast') SELECT row_id, """
    + ", ".join(
        f"round((l.{f} - (SELECT avg({f}) FROM train)) / (SELECT CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END FROM train), 4) AS {f}"
        for f in _SCALED
    )
    + " FROM labelled l",
)
_add(
    "m05_class_weight",
    lambda t: M.pos_weight(models.targets(_labelled(t)), "y_slow").withColumn("pos_weight", F.round("pos_weight", 6)),
    f"""WITH {_LABELLED_SQL} SELECT count(*) FILTER (label = 'slow') AS slow, count(*) FILTER (label = 'fast') AS fast,
         round(count(*) FILTER (label = 'fast') / greatest(count(*) FILTER (label = 'slow'), 1), 6) AS pos_weight FROM labelled""",
)


def _fitting_rows(t):
    """Every event with numeric features of its statement's text; slow above the label threshold."""
    rows = t.events.select("event_id", "user_id", "event_type", c("value").alias("execution_time_warm_ms")).withColumns(
        {
            "is_error": (c("event_type") == "error").cast("double"),
            "is_click": (c("event_type") == "click").cast("double"),
            "label": F.when(c("execution_time_warm_ms") > X.LABEL_MS, "slow").otherwise("fast"),
        }
    )
    return models.targets(rows)


_FIT = ["is_error", "is_click", "user_id"]


def _slow_model(t):
    scorer = models.fit_scorer(_fitting_rows(t), _FIT)
    rows = _fitting_rows(t).withColumns({"p_slow": scorer.p_slow(), "predicted_ms": scorer.predicted_ms()})
    return rows.select("event_id", "label", "p_slow", "predicted_ms")


_add("m06_slow_model", _slow_model)


def _slow_model_judged(t):
    """Fitted on four fifths of the events, saved, loaded and judged by what only a right fit satisfies.

    At the optimum of the weighted likelihood the weighted residuals sum to zero, also times each feature, and the
    weighted log loss of the training rows is at most that of the constant 0.5. The test events hold hardly any signal,
    so on the n rows held out the loss only has to stay within 3 / sqrt(n) of it.
    """
    rows, path = _fitting_rows(t), scratch_path(t.spark, "scorer")
    held = F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0
    models.fit_scorer(rows.filter(~held), _FIT).save(t.spark, path)
    scorer = Scorer.load(t.spark, path)
    scored = rows.withColumns({"p": scorer.p_slow(), "held": held})
    n_slow, n_fast = F.sum(F.when(~c("held"), c("y_slow"))), F.sum(F.when(~c("held"), 1 - c("y_slow")))
    scored = scored.withColumn("weight", F.when(c("y_slow") == 1, scored.agg((n_fast / n_slow).alias("w")).scalar()).otherwise(1.0))
    left = F.when(~c("held"), c("weight") * (c("y_slow") - c("p")))
    loss = -c("weight") * F.ln(F.when(c("y_slow") == 1, c("p")).otherwise(1 - c("p")))
    total = F.sum(F.when(~c("held"), c("weight")))
    one = scored.agg(
        (F.abs(F.sum(left)) / total < 1e-3).alias("intercept"),
        *[(F.abs(F.sum(left * (c(f) - m) / s)) / total < 1e-3).alias(f) for f, m, s in zip(scorer.features, scorer.means, scorer.scales)],
        (F.sum(F.when(~c("held"), loss)) / total < F.ln(F.lit(2.0)) + 1e-6).alias("trained"),
        (F.sum(F.when(c("held"), loss)) / F.sum(F.when(c("held"), c("weight"))) < F.ln(F.lit(2.0)) + 3 / F.sqrt(F.count_if("held"))).alias("held_out"),
        F.count("*").alias("n"),
    )
    return one.unpivot(["n"], ["intercept", *_FIT, "trained", "held_out"], "condition", "holds")


_add(
    "m06_slow_model_judged",
    _slow_model_judged,
    "SELECT n, condition, TRUE AS holds FROM (SELECT count(*) AS n FROM events), unnest(['intercept', 'is_error', 'is_click', 'user_id', 'trained', 'held_out']) AS x(condition)",
)
_add(
    "m06_perceptron",
    lambda t: models.fit_perceptron(_fitting_rows(t), _FIT).transform(_fitting_rows(t)).select("event_id", "label", "prediction"),
)


def _quantile_model(t):
    """Log price on quantity, discount and tax at the 0.7 quantile, judged by the share of rows below."""
    rows = models.targets(_labelled(t)).select(*NUMBERS, "y_log")
    weights, bias = models.fit_quantile(rows, NUMBERS)
    predicted = F.lit(bias)
    for name, w in zip(NUMBERS, weights):
        predicted = predicted + c(name) * F.lit(w)
    return rows.agg(F.count("*").alias("n"), F.round(F.avg((c("y_log") <= predicted).cast("double")), 3).alias("below"))


# the best intercept leaves the share tau below, whatever the weights are
_add("m07_quantile_model", _quantile_model, "SELECT count(*) AS n, 0.7::DOUBLE AS below FROM lineitem")
_add(
    "m07_squared_model",
    lambda t: models.fit_squared(models.targets(_labelled(t)), NUMBERS)
    .transform(models.assemble(models.targets(_labelled(t)), NUMBERS))
    .select("row_id", "y_log", "prediction"),
)

# ---- fits with a closed form: with an indicator per group the best fit of each group is known

_GROUPS = range(2, 8)
_INDICATORS = [f"line_{k}" for k in _GROUPS]


def _grouped(t):
    """Lineitems with an indicator of each line number but the first."""
    rows = models.targets(_labelled(t)).withColumns({f"line_{k}": (c("l_linenumber") == k).cast("double") for k in _GROUPS})
    return rows.select("l_linenumber", *_INDICATORS, "label", "y_slow", "y_log")


def _slow_by_group(t):
    """The weighted logistic fit gives each group its weighted share of slow rows."""
    rows = _grouped(t)
    model = models.fit_slow_model(rows, _INDICATORS)
    p = F.get(_vector_values("probability"), F.lit(1))
    return model.transform(models.assemble(rows, _INDICATORS)).groupBy("l_linenumber").agg(
        F.count("*").alias("n"), F.round(F.max(p), 3).alias("p_most"), F.round(F.min(p), 3).alias("p_least")
    )


_add(
    "m06_slow_by_group",
    _slow_by_group,
    f"""WITH {_LABELLED_SQL}, w AS (SELECT count(*) FILTER (label = 'fast') / count(*) FILTER (label = 'slow') AS w FROM labelled),
       p AS (SELECT l_linenumber, count(*) AS n, any_value(w) * count(*) FILTER (label = 'slow') AS s, count(*) FILTER (label = 'fast') AS f FROM labelled, w GROUP BY l_linenumber)
       SELECT l_linenumber, n, round(s / (s + f), 3) AS p_most, round(s / (s + f), 3) AS p_least FROM p""",
)


def _perceptron_by_group(t):
    """The class the network gives to each decade of the quantity is the one with the larger weighted share.

    Slow are the quantities from 20 to 39, a band that no linear model parts, but for rows of high tax.
    """
    band = c("l_quantity").between(20, 39)
    rows = t.lineitem.select(
        F.floor(c("l_quantity") / 10).cast("double").alias("decade"),
        F.when(c("l_tax") >= 0.07, ~band).otherwise(band).cast("double").alias("y_slow"),
    )
    model = models.fit_perceptron(rows, ["decade"])
    return model.transform(rows).groupBy(c("decade").cast("int").alias("decade")).agg(
        F.count("*").alias("n"), F.max("prediction").alias("most"), F.min("prediction").alias("least")
    )


_add(
    "m06_perceptron_by_group",
    _perceptron_by_group,
    """WITH r AS (SELECT CAST(floor(l_quantity / 10) AS INTEGER) AS decade, (l_quantity BETWEEN 20 AND 39) <> (l_tax >= 0.07) AS slow FROM lineitem),
       w AS (SELECT count(*) FILTER (NOT slow) / count(*) FILTER (slow) AS w FROM r)
       SELECT decade, count(*) AS n, CAST(any_value(w) * count(*) FILTER (slow) > count(*) FILTER (NOT slow) AS DOUBLE) AS most,
         CAST(any_value(w) * count(*) FILTER (slow) > count(*) FILTER (NOT slow) AS DOUBLE) AS least FROM r, w GROUP BY decade""",
)


def _quantile_by_group(t):
    """The pinball loss of each group is the least there is, that of its own quantile."""
    rows = _grouped(t)
    weights, bias = models.fit_quantile(rows, _INDICATORS)
    predicted = F.lit(bias)
    for name, w in zip(_INDICATORS, weights):
        predicted = predicted + c(name) * F.lit(w)
    gap = c("y_log") - predicted
    loss = F.greatest(M.TAU * gap, (M.TAU - 1) * gap)
    return rows.groupBy("l_linenumber").agg(F.count("*").alias("n"), r4(F.avg(loss), "pinball"))


_add(
    "m07_quantile_by_group",
    _quantile_by_group,
    f"""WITH {_LABELLED_SQL}, q AS (SELECT l_linenumber AS line, quantile_cont(ln(1 + ms), 0.7) AS q FROM labelled GROUP BY line)
       SELECT l_linenumber, count(*) AS n, round(avg(greatest(0.7 * (ln(1 + ms) - q), -0.3 * (ln(1 + ms) - q))), 4) AS pinball
       FROM labelled JOIN q ON line = l_linenumber GROUP BY l_linenumber""",
)


def _quantile_slopes(t):
    """No direction lowers the loss of the fit of m07_quantile_model."""
    rows = models.targets(_labelled(t)).select(*NUMBERS, "y_log")
    weights, bias = models.fit_quantile(rows, NUMBERS)
    slopes = models.quantile_slopes(rows, NUMBERS, weights, bias)
    n = rows.agg(F.count("*")).scalar()
    return slopes.unpivot([], ["intercept", *NUMBERS], "direction", "slope").select(n.alias("n"), "direction", (c("slope") < 5e-3).alias("flat"))


_add(
    "m07_quantile_slopes",
    _quantile_slopes,
    f"SELECT n, direction, TRUE AS flat FROM (SELECT count(*) AS n FROM lineitem), unnest({['intercept', *NUMBERS]}) AS x(direction)",
)


def _squared_by_group(t):
    """Trees deep enough to part the groups predict each group's mean."""
    rows = models.assemble(_grouped(t), ["l_linenumber"])
    model = models.fit_squared(_grouped(t), ["l_linenumber"], depth=6)
    return model.transform(rows).groupBy("l_linenumber").agg(
        F.count("*").alias("n"), r4(F.max("prediction"), "most"), r4(F.min("prediction"), "least")
    )


_add(
    "m07_squared_by_group",
    _squared_by_group,
    f"""WITH {_LABELLED_SQL} SELECT l_linenumber, count(*) AS n, round(avg(ln(1 + ms)), 4) AS most, round(avg(ln(1 + ms)), 4) AS least
       FROM labelled GROUP BY l_linenumber""",
)

# ---- metrics on the scored lineitems

_add(
    "m08_joint_loss",
    lambda t: M.joint_loss(t.predictions, "actual", "logit", "true_log", "predicted_log", F.lit(1.5)).select(
        *[F.round(n, 6).alias(n) for n in ("bce", "qloss", "loss")]
    ),
    f"""WITH {X.SQL_PREDICTIONS}, l AS (SELECT avg(CASE WHEN actual = 1 THEN -1.5 * ln(p_slow) ELSE -ln(1 - p_slow) END) AS bce,
         avg(CASE WHEN true_log >= predicted_log THEN 0.7 * (true_log - predicted_log) ELSE 0.3 * (predicted_log - true_log) END) AS q FROM predictions)
       SELECT round(bce, 6) AS bce, round(q, 6) AS qloss, round(0.6 * bce + 0.4 * q, 6) AS loss FROM l""",
)
_add(
    "m09_confusion",
    lambda t: M.confusion(t.predictions, "actual", "predicted"),
    f"""WITH {X.SQL_PREDICTIONS}, cells AS (SELECT unnest([0, 0, 1, 1]) AS actual, unnest([0, 1, 0, 1]) AS predicted)
       SELECT c.actual, c.predicted, count(p.row_id) AS n FROM cells c LEFT JOIN predictions p USING (actual, predicted) GROUP BY ALL""",
)


def _report_sql():
    def part(k):
        return f"""count(*) FILTER (actual = {k} AND predicted = {k}) / count(*) FILTER (predicted = {k}) AS p{k},
          count(*) FILTER (actual = {k} AND predicted = {k}) / count(*) FILTER (actual = {k}) AS r{k}, count(*) FILTER (actual = {k}) AS s{k}"""

    return f"""WITH {X.SQL_PREDICTIONS}, one AS (SELECT {part(0)}, {part(1)}, count(*) AS n, avg(CAST(actual = predicted AS INTEGER)) AS acc FROM predictions),
      two AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM one),
      lines AS (SELECT 'fast' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM two
        UNION ALL SELECT 'slow', p1, r1, f1, s1 FROM two UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM two
        UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM two
        UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM two)
      SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM lines"""


_add(
    "m10_classification_report",
    lambda t: M.classification_report(t.predictions, "actual", "predicted").select(
        "class", "support", *[F.round(n, 6).alias(n) for n in ("precision", "recall", "f1")]
    ),
    _report_sql(),
)
_add(
    "m11_roc_points",
    lambda t: M.roc_points(t.predictions, "actual", "p_slow").select(*[F.round(n, 6).alias(n) for n in ("threshold", "fpr", "tpr")]),
    f"""WITH {X.SQL_PREDICTIONS}, s AS (SELECT p_slow, count(*) FILTER (actual = 1) AS p, count(*) FILTER (actual = 0) AS n FROM predictions GROUP BY p_slow)
       SELECT round(p_slow, 6) AS threshold, round(sum(n) OVER w / (SELECT sum(n) FROM s), 6) AS fpr, round(sum(p) OVER w / (SELECT sum(p) FROM s), 6) AS tpr
       FROM s WINDOW w AS (ORDER BY p_slow DESC)""",
)
_add(
    "m11_auc",
    lambda t: M.auc(t.predictions, "actual", "p_slow").withColumn("auc", F.round("auc", 6)),
    f"""WITH {X.SQL_PREDICTIONS}, s AS (SELECT p_slow, count(*) FILTER (actual = 1) AS p, count(*) FILTER (actual = 0) AS n FROM predictions GROUP BY p_slow)
       SELECT round(sum(hi.n * lo.p * CASE WHEN lo.p_slow > hi.p_slow THEN 1.0 WHEN lo.p_slow = hi.p_slow THEN 0.5 ELSE 0 END)
         / ((SELECT sum(p) FROM s) * (SELECT sum(n) FROM s)), 6) AS auc FROM s hi, s lo""",
)
_add(
    "m12_regression_metrics",
    lambda t: M.regression_metrics(t.predictions, "true_log", "predicted_log").select(*[F.round(n, 6).alias(n) for n in ("log_mae", "ms_mae", "r2")]),
    f"""WITH {X.SQL_PREDICTIONS} SELECT round(avg(abs(predicted_log - true_log)), 6) AS log_mae,
         round(avg(abs(exp(predicted_log) - exp(true_log))), 6) AS ms_mae,
         round(1 - sum((true_log - predicted_log) ** 2) / sum((true_log - (SELECT avg(true_log) FROM predictions)) ** 2), 6) AS r2 FROM predictions""",
)
_add(
    "m13_top_correlations",
    lambda t: M.top_correlations(_labelled(t), [*_SCALED, "l_suppkey"], F.log1p("execution_time_warm_ms")).withColumn("correlation", F.round("correlation", 6)),
    f"WITH {_LABELLED_SQL}, all_of AS ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, corr({f}, ln(1 + ms)) AS r FROM labelled" for f in [*NUMBERS, "l_suppkey"])
    + ") SELECT feature, round(r, 6) AS correlation FROM all_of ORDER BY abs(r) DESC LIMIT 5",
)
_add(
    "m14_class_balance",
    lambda t: M.class_balance(_labelled(t)).withColumn("slow_pct", F.round("slow_pct", 4)),
    f"""WITH {_LABELLED_SQL} SELECT count(*) AS total, count(*) FILTER (label = 'slow') AS slow, count(*) FILTER (label = 'fast') AS fast,
         round(100.0 * count(*) FILTER (label = 'slow') / count(*), 4) AS slow_pct, count(*) FILTER (l_tax > 0.07) AS timed_out FROM labelled""",
)
_add(
    "m15_mean_time_by_class",
    lambda t: M.mean_time_by_class(_labelled(t)).withColumn("mean_ms", F.round("mean_ms", 4)),
    f"WITH {_LABELLED_SQL} SELECT label, round(avg(ms), 4) AS mean_ms FROM labelled GROUP BY label",
)
_add(
    "m16_log_histogram",
    lambda t: M.log_histogram(_labelled(t), "label", "execution_time_warm_ms"),
    f"""WITH {_LABELLED_SQL}, x AS (SELECT label, log10(greatest(ms, 0.05)) AS v FROM labelled),
       e AS (SELECT label, min(v) AS lo, max(v) AS hi FROM x GROUP BY label)
       SELECT label, CAST(least(40, floor((v - lo) / (hi - lo) * 40) + 1) AS INTEGER) AS bin, count(*) AS n FROM x JOIN e USING (label) GROUP BY ALL""",
)
_add(
    "m17_low_cardinality_means",
    lambda t: M.low_cardinality_means(_labelled(t), "label", [*_SCALED, "l_suppkey", "timed_out_runs"]).withColumn("mean", F.round("mean", 6)),
    f"WITH {_LABELLED_SQL}, r AS (SELECT *, CAST(l_tax > 0.07 AS INTEGER) AS timed_out_runs FROM labelled), all_of AS ("
    + " UNION ALL ".join(
        f"""SELECT label, '{f}' AS feature, avg({f}) AS mean FROM r WHERE (SELECT count(DISTINCT {f}) <= 2 OR max({f}) <= 10 FROM r) GROUP BY label"""
        for f in [*_SCALED, "l_suppkey", "timed_out_runs"]
    )
    + ") SELECT label, feature, round(mean, 6) AS mean FROM all_of",
)
_add(
    "m18_box_summary",
    lambda t: M.box_summary(_labelled(t), "label", ["execution_time_warm_ms", "l_suppkey"]).select(
        "feature", "label", *[F.round(n, 6).alias(n) for n in ("q1", "median", "q3")]
    ),
    f"WITH {_LABELLED_SQL}, r AS (SELECT label, ms AS execution_time_warm_ms, l_suppkey FROM labelled) "
    + " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, label, round(quantile_cont(log10(greatest({f}, 1)), 0.25), 6) AS q1, round(median(log10(greatest({f}, 1))), 6) AS median,
              round(quantile_cont(log10(greatest({f}, 1)), 0.75), 6) AS q3 FROM r GROUP BY label"""
        for f in ["execution_time_warm_ms", "l_suppkey"]
    ),
)
_add(
    "m19_worst_errors",
    lambda t: M.worst_errors(t.predictions, "actual", "predicted", "p_slow", "row_id").select(
        "row_id", "error", c("rank").cast("bigint").alias("rank"), r4(c("p_slow"), "p_slow")
    ),
    f"""WITH {X.SQL_PREDICTIONS}, e AS (
         SELECT row_id, p_slow, 'false_positive' AS error, row_number() OVER (ORDER BY p_slow DESC, row_id) AS rank FROM predictions WHERE actual = 0 AND predicted = 1
         UNION ALL SELECT row_id, p_slow, 'false_negative', row_number() OVER (ORDER BY p_slow, row_id) FROM predictions WHERE actual = 1 AND predicted = 0)
       SELECT row_id, error, rank, round(p_slow, 4) AS p_slow FROM e WHERE rank <= 5""",
)
_add(
    "m20_residuals",
    lambda t: M.residual_summary(t.predictions, "true_log", "predicted_log").select(*[F.round(n, 6).alias(n) for n in ("mean", "std", "min", "max")]),
    f"""WITH {X.SQL_PREDICTIONS} SELECT round(avg(predicted_log - true_log), 6) AS mean, round(stddev_pop(predicted_log - true_log), 6) AS std,
         round(min(predicted_log - true_log), 6) AS min, round(max(predicted_log - true_log), 6) AS max FROM predictions""",
)
_add(
    "m21_best_epoch",
    # each customer's orders as one training run: the price is the loss, the key the epoch
    lambda t: M.best_epoch(
        t.orders.select(c("o_custkey").alias("run"), c("o_orderkey").alias("epoch"), F.floor(c("o_totalprice") / 50000).cast("double").alias("loss")), "run", "epoch", "loss"
    ),
    """SELECT o_custkey AS run, min(floor(o_totalprice / 50000)) AS best_loss,
         arg_min(o_orderkey, floor(o_totalprice / 50000) * 1e9 + o_orderkey) AS best_epoch FROM orders GROUP BY o_custkey""",
)

# ---- vectors


def _sides(t):
    return (
        t.embeddings.select(c("vec_id").alias("lookup_id"), c("embedding").alias("vector")),
        t.embeddings.select(c("vec_id").alias("entry_id"), c("embedding").alias("vector")),
    )


def _neighbours(t):
    """Each vector beside the next one, for the plain similarity column."""
    left = t.embeddings.select("vec_id", c("embedding").alias("a"))
    right = t.embeddings.select((c("vec_id") - 1).alias("vec_id"), c("embedding").alias("b"))
    return left.join(right, "vec_id").select("vec_id", r4(N.cosine(c("a"), c("b")), "similarity"))


_add(
    "v01_cosine",
    _neighbours,
    """SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS similarity
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
_add(
    "v02_best_match",
    lambda t: vectors.with_similar_fix(*_sides(t), threshold=0.4, exclude_same_id=True).select("lookup_id", "entry_id", r4(c("similarity"), "similarity")),
    f"""WITH {SQL_SIMILAR} SELECT e.vec_id AS lookup_id, p.entry_id, round(p.similarity, 4) AS similarity
       FROM embeddings e LEFT JOIN placed p ON p.lookup_id = e.vec_id AND p.rank = 1""",
)
_add(
    "v02_best_three",
    lambda t: vectors.similar_fixes(*_sides(t), threshold=0.4, k=3, exclude_same_id=True, block_rows=128).select(
        "lookup_id", "entry_id", c("rank").cast("bigint").alias("rank"), r4(c("similarity"), "similarity")
    ),
    f"WITH {SQL_SIMILAR} SELECT lookup_id, entry_id, rank, round(similarity, 4) AS similarity FROM placed WHERE rank <= 3",
)
_add(
    "v04_indexed_lookup",
    # the index is built once and serves any number of lookups
    lambda t: (lambda asked, history: vectors.similar_fixes(asked, history, threshold=0.4, k=5, exclude_same_id=True, index=vectors.build_index(history, cell=64)))(*_sides(t)).select(
        "lookup_id", "entry_id", c("rank").cast("bigint").alias("rank"), r4(c("similarity"), "similarity")
    ),
    f"WITH {SQL_SIMILAR} SELECT lookup_id, entry_id, rank, round(similarity, 4) AS similarity FROM placed WHERE rank <= 5",
)
_add(
    "v03_similarity_stats",
    lambda t: vectors.similarity_stats(vectors.with_similar_fix(*_sides(t), threshold=0.4, exclude_same_id=True)).withColumn(
        "mean_similarity", F.round("mean_similarity", 6)
    ),
    f"""WITH {SQL_SIMILAR} SELECT (SELECT count(*) FROM embeddings) AS lookups, count(*) AS found, round(avg(similarity), 6) AS mean_similarity
       FROM placed WHERE rank = 1""",
)
