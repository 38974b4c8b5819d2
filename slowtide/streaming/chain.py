"""The monitor's work on one poll of statements: features, score, gate, lookup, candidates, rank, verify, event, store.

Each stage's result that others read is written once per poll, in the poll's own folder, so a repeated poll replaces it
and no stage computes another one's rows again. A statement that a stage cannot handle goes to the quarantine with the
stage's name; if a stage fails as a whole (a source is down), the statements it was given go there too and the stream
goes on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.functions.plantree import plan_features, plan_rejected
from slowtide.functions.scorer import FEATURES, Scorer
from slowtide.functions.text import text_features
from slowtide.operators import candidates as C
from slowtide.operators.vectors import with_similar_fix
from slowtide.sources.files import HISTORY, read_history
from slowtide.streaming.monitor import write_batch

STATEMENT = ["stmt", "query", "mean_exec_time", "calls", "plan", "vector", "timestamp"]


@dataclass(frozen=True)
class Sources:
    """What other systems do: generated answers, plans of candidates, and measured times.

    `answers` gets statements (stmt, query, ..) and returns stmt, query, mean_exec_time, position and raw; `plans` adds
    the plan features to candidates (stmt, sql, ..); `measured` gets ranked candidates and returns stmt, sql, cold_ms,
    warm_ms and all_runs_ms.
    """

    answers: Callable[[DataFrame], DataFrame]
    plans: Callable[[DataFrame], DataFrame]
    measured: Callable[[DataFrame], DataFrame]
    name: str = "generated"


class Poll:
    """One poll's folders: a written stage result is read back as a frame over its files."""

    def __init__(self, spark, path: str, batch_id: int):
        self.spark, self.path, self.batch_id = spark, path, batch_id

    def deal(self, rows: DataFrame) -> DataFrame:
        """The rows dealt over the cores: a poll of few bytes comes in few files, and plans, texts and answers are slow to read."""
        return rows.repartition(self.spark.sparkContext.defaultParallelism)

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        write_batch(rows, self.batch_id, f"{self.path}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}/batch_id={self.batch_id}")

    def set_aside(self, rows: DataFrame, stage: str, why: str = "") -> None:
        shown = rows.select("stmt", "query", F.lit(why).alias("why"))
        write_batch(shown, self.batch_id, f"{self.path}/quarantine/stage={stage}")

    def split(self, rows: DataFrame, good: Column, stage: str) -> DataFrame:
        """The rows that are good; the others go to the quarantine (a condition that is null is not good)."""
        told = F.coalesce(good, F.lit(False))
        self.set_aside(rows.filter(~told), stage)
        return rows.filter(told)


def _featured(poll: Poll, rows: DataFrame) -> DataFrame:
    valid = F.col("stmt").isNotNull() & F.col("query").isNotNull() & (F.col("mean_exec_time") >= 0) & ~F.isnan("mean_exec_time")
    plans = {"tree": plan_features(F.col("plan")), "rejected": plan_rejected(F.col("plan"))}
    parsed = poll.keep(poll.deal(rows.select(*STATEMENT)).withColumns(plans).drop("plan"), "parsed")
    known = poll.split(parsed, valid, "statement")
    read = poll.split(known, ~F.col("rejected"), "plan").drop("rejected")
    features = read.withColumns(text_features(F.col("query")))
    return poll.keep(features.select("*", "tree.*").drop("tree"), "features")


def _gated(poll: Poll, featured: DataFrame, scorer: Scorer, minimum: float) -> DataFrame:
    scored = featured.withColumns({"p_slow": scorer.p_slow(), "predicted_ms": scorer.predicted_ms()})
    sure = poll.split(scored, ~F.isnan("p_slow") & ~F.isnan("predicted_ms"), "score")
    return C.gate(sure, minimum)


def _looked_up(poll: Poll, gated: DataFrame, history_path: str, similarity: dict) -> DataFrame:
    past = read_history(poll.spark, history_path)
    if "batch_id" in past.columns:  # what this poll stored before it was repeated is not its past
        past = past.filter(F.col("batch_id") < poll.batch_id)
    asked = gated.select(F.xxhash64("stmt").alias("lookup_id"), "vector")
    found = with_similar_fix(asked, past.select("entry_id", "vector"), **similarity).select("lookup_id", "entry_id", "similarity")
    met = gated.withColumn("lookup_id", F.xxhash64("stmt")).join(found, "lookup_id").drop("lookup_id")
    return poll.keep(poll.deal(met.withColumn("similar_fix_used", F.col("entry_id").isNotNull())), "handled")


def _ranked(poll: Poll, handled: DataFrame, scorer: Scorer, sources: Sources) -> DataFrame:
    found = C.extract_candidates(sources.answers(handled), "stmt", "position")
    scored = sources.plans(found).withColumns(text_features(F.col("sql"))).withColumn("predicted_ms", scorer.predicted_ms())
    return poll.keep(C.rank_candidates(scored.drop(*FEATURES), "stmt", "position", "mean_exec_time"), "ranked")


def _stored(poll: Poll, handled: DataFrame, ranked: DataFrame, sources: Sources, history_path: str) -> None:
    verified = poll.keep(C.verify(ranked, sources.measured(ranked), "stmt", "mean_exec_time"), "verified")
    write_batch(C.assemble_events(handled, ranked, verified, "stmt", "position", sources.name), poll.batch_id, f"{poll.path}/events")
    won = verified.filter("measured_speedup_ms > 0").join(handled.select("stmt", "vector").filter("vector is not null"), "stmt")
    fixes = won.select(
        F.xxhash64("stmt", F.lit(poll.batch_id)).alias("entry_id"), F.col("query").alias("slow_query"), F.col("sql").alias("fix"),
        F.col("measured_speedup_ms").alias("speedup_ms"), F.col("vector").cast("array<float>").alias("vector"),
    )
    write_batch(fixes.select(*[part.split()[0] for part in HISTORY.split(", ")]), poll.batch_id, history_path)


def watch(path: str, history_path: str, scorer: Scorer, sources: Sources, minimum: float = C.P_SLOW_GATE, **similarity) -> Callable[[DataFrame, int], None]:
    """Per poll of statements (`STATEMENT`): write events, quarantine and new fixes below `path` and `history_path`.

    The history is read again for each poll, so fixes stored by earlier polls are found.
    """

    def each(rows: DataFrame, batch_id: int) -> None:
        poll = Poll(rows.sparkSession, path, batch_id)
        now, stage = rows, "statement"
        try:
            now = featured = _featured(poll, rows)
            stage = "lookup"
            now = handled = _looked_up(poll, _gated(poll, featured, scorer, minimum), history_path, similarity)
            stage = "candidates"
            ranked = _ranked(poll, handled, scorer, sources)
            stage = "events"
            _stored(poll, handled, ranked, sources, history_path)
        except Exception as failure:
            poll.set_aside(now, f"failed_{stage}", f"{type(failure).__name__}: {failure}"[:500])

    return each


def quarantined(spark, path: str) -> DataFrame:
    """stmt, query, stage and why of every statement that was set aside."""
    return spark.read.schema("stmt string, query string, why string, stage string, batch_id bigint").parquet(f"{path}/quarantine")

