"""Files in every format, bad input included, and streams that stop and go on."""

import re
import json
import os
from collections import Counter

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from slowtide.operators.pairs import insert_absent
from slowtide.sources import files
from slowtide.streaming import monitor as M

c = F.col


def test_dump_with_bad_rows(spark, tmp_path):
    rows = [
        '<row Id="1" DisplayName="a &amp; b" Reputation="5" CreationDate="2020-01-02T03:04:05.670" />',
        '<row Id="2" DisplayName="c" Location="Paris" CreationDate="2020-01-02T03:04:05" />',
        '<row Id="x" DisplayName="bad id" />',
        '<row Id="3" DisplayName="bad number" Reputation="many" />',
        '<row DisplayName="no id" />',
        '<row Id="1" DisplayName="again" Reputation="9" />',
    ]
    path = tmp_path / "Users.xml"
    path.write_text('<?xml version="1.0" encoding="utf-8"?>\n<users>\n' + "\n".join(rows) + "\n</users>")
    typed = files.typed(files.read_dump(spark, str(path), "users"), "users")
    good = sorted((r.id, r.display_name, r.location, r.reputation) for r in files.accepted(typed).collect())
    assert good == [(1, "a & b", None, 5), (1, "again", None, 9), (2, "c", "Paris", 0)]
    assert sorted(str(r.DisplayName) for r in files.quarantined(typed).collect()) == ["bad id", "bad number", "no id"]
    target = spark.createDataFrame([(2,)], "id int")
    new = insert_absent(files.accepted(typed), target, "id", [F.col("reputation")])
    assert [(r.id, r.display_name) for r in new.collect()] == [(1, "a & b")]


LAYOUTS = """\ufeff<?xml version="1.0" encoding="utf-8"?>
<!-- six elements, five of them whole -->
<rows>
  <row Id="1" DisplayName="a" />
\t<row Id='2' DisplayName='tab &quot;q&quot; > b'/> <row Id="3" DisplayName="same line"></row>
  <row Id="4"
       DisplayName="over
lines" />
  <row Id="5" DisplayName="cut off
  some words <row Id="6" Reputation="7"/>
  <ro Id="7" /> lost
</rows>
"""


@pytest.mark.parametrize("size", ["16", "128m"])
def test_dump_layouts(spark, tmp_path, size):
    (tmp_path / "Users.xml").write_text(LAYOUTS, encoding="utf-8")
    path = str(tmp_path / "Users.xml")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = {r.Id: r for r in files.read_dump(spark, path, "users").collect()}
        assert sorted(rows) == ["1", "2", "3", "4", "6"]
        assert rows["2"].DisplayName == 'tab "q" > b' and rows["6"].Reputation == "7" and rows["4"].DisplayName.split() == ["over", "lines"]
        rejected = sorted(r.raw for r in files.rejected_dump(spark, path, "users").collect())
        assert [r.split()[0] for r in rejected] == ["<ro", "<row"] and "cut off" in rejected[1] and "some words" in rejected[1] and "lost" in rejected[0]
        assert spark.read.option("lineSep", "<row").text(path).rdd.getNumPartitions() > 3 or size != "16"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_dump_elements_with_unknown_entities_are_rejected(spark, tmp_path):
    (tmp_path / "u.xml").write_text('<users><row Id="1" DisplayName="a&nbsp;b"/><row Id="2"/></users>')
    assert [r.Id for r in files.read_dump(spark, str(tmp_path / "u.xml"), "users").collect()] == ["2"]
    assert [r.raw for r in files.rejected_dump(spark, str(tmp_path / "u.xml"), "users").collect()] == ['<row Id="1" DisplayName="a&nbsp;b"/>']


@pytest.mark.parametrize("size", ["40", "200", "128m"])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_foreign_measurements(spark, tmp_path, size, ending):
    """Quoted line breaks, quotes and backslashes; bad cells are set aside; a file may be cut anywhere."""
    n = len(files.MEASUREMENT.fields)
    texts = ["SELECT 1", "a\nb", 'say ""x""\n\n, y', "C:\\new", "long " + "line\n" * 40, "", "end"]
    lines = [",".join(f.name for f in files.MEASUREMENT.fields)]
    lines += [f'{i},"{t}",1.5' + ",0" * (n - 3) for i, t in enumerate(texts)]
    lines.insert(3, 'many,"bad id\nhere",1.5' + ",0" * (n - 3))
    lines.insert(5, "77,too few cells")
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.csv").write_bytes(ending.join(x.replace("\n", ending) for x in lines).encode() + ending.encode())
    (tmp_path / "m" / "b.csv").write_bytes((lines[0] + ending + '100,"other\nfile",2.5' + ",0" * (n - 3)).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.query_id: r.query_text for r in files.read_measurements(spark, str(tmp_path / "m")).collect()}
        want = {i: t.replace('""', '"').replace("\n", ending) or None for i, t in enumerate(texts)} | {100: "other\nfile"}
        assert got == want
        bad = sorted(r.raw for r in files.rejected_measurements(spark, str(tmp_path / "m")).collect())
        assert [b.split(",")[0] for b in bad] == ["77", "many"] and f"bad id{ending}here" in bad[1]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_measurements_survive_csv(spark, tmp_path):
    path = str(tmp_path / "m")
    text = 'SELECT "a", \'b\'\nFROM t -- x, "y" \\n \\\\ \r'
    row = {f.name: None for f in files.MEASUREMENT.fields} | {"query_id": 7, "query_text": text, "all_runs_ms": "1.00;2.50"}
    files.append_measurements(spark.createDataFrame([tuple(row.values())], files.MEASUREMENT), path, "csv")
    back = files.read_measurements(spark, path).first()
    assert (back.query_id, back.query_text, back.all_runs_ms, back.join_count) == (7, text, "1.00;2.50", None)
    assert len(files.MEASUREMENT.fields) == 28


def test_logs_absent_corrupt_and_appended(spark, tmp_path):
    path = str(tmp_path / "log")
    assert files.read_log(spark, path).count() == 0
    one = spark.createDataFrame([{"query": "q", "pg_stat_mean_ms": 5.0}], files.EVENT)
    files.append_log(one, path)
    files.append_log(one, path)
    (tmp_path / "log" / "broken.json").write_text('{"query": "cut of')
    assert files.read_log(spark, path).count() == 2
    array = tmp_path / "array.json"
    array.write_text(json.dumps([{"query": "a", "model": {"p_slow": 0.5}}, {"query": "b", "candidates_ranked": [{"sql": "s"}]}], indent=2))
    got = {r["query"]: r for r in files.read_log(spark, str(array), lines=False).collect()}
    assert got["a"].model.p_slow == 0.5 and got["b"].candidates_ranked[0].sql == "s"


def test_history_grows(spark, tmp_path):
    path = str(tmp_path / "h")
    assert files.read_history(spark, path).count() == 0
    fix = spark.createDataFrame([(1, "s", "f", 2.0, [0.5, 0.5])], files.HISTORY)
    files.append_history(fix, path)
    files.append_history(fix.withColumn("entry_id", F.lit(2).cast("bigint")), path)
    assert sorted(r.entry_id for r in files.read_history(spark, path).collect()) == [1, 2]


# ---- streams


SCHEMA = "query string, ms double, ts timestamp"


def _feed(spark, folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    out = spark.createDataFrame(rows, "query string, ms double, s string").select("query", "ms", c("s").cast("timestamp").alias("ts"))
    out.toPandas().to_parquet(f"{folder}/{name}.parquet", coerce_timestamps="us", index=False)


def _drain(stream, each, checkpoint, mode="append"):
    M.start(stream, each, checkpoint, mode, drain=True).awaitTermination()


@pytest.fixture()
def place(tmp_path):
    return {n: str(tmp_path / n) for n in ("in", "out", "check", "bad", "parts")}


def test_first_seen_over_restarts(spark, place):
    long = "SELECT " + "x" * 120
    _feed(spark, place["in"], "a", [("q1", 1.0, "2024-01-01 00:00:00"), (long + "1", 1.0, "2024-01-01 00:01:00"), ("q1", 2.0, "2024-01-01 00:02:00"), (None, 1.0, "2024-01-01 00:00:00")])
    stream = lambda: M.executions(spark, place["in"], SCHEMA, files_per_poll=1)
    each = M.keep_first_seen(place["out"], "10 days")
    _drain(stream(), each, place["check"])
    _feed(spark, place["in"], "b", [("q1", 1.0, "2024-01-02 00:00:00"), (long + "2", 1.0, "2024-01-02 00:00:00"), ("q2", 1.0, "2024-01-20 00:00:00"), (None, 1.0, "2024-01-02 00:00:00")])
    _drain(stream(), each, place["check"])
    found = [r["query"] for r in spark.read.parquet(f"{place['out']}/new").collect()]
    assert Counter(found) == Counter(["q1", long + "1", long + "2", "q2", None])
    # ten days before the 20th: late rows are set aside, a key that was met before that is new again, and a repeated poll changes nothing
    _feed(spark, place["in"], "c", [("q3", 1.0, "2024-01-09 00:00:00"), ("q1", 1.0, "2024-01-21 00:00:00"), ("q2", 5.0, "2024-01-11 00:00:00"), ("q4", 1.0, None)])
    _drain(stream(), each, place["check"])
    each(spark.read.schema(SCHEMA).parquet(f"{place['in']}/c.parquet"), 2)
    assert Counter(r["query"] for r in spark.read.parquet(f"{place['out']}/late").collect()) == Counter(["q3", "q4"])
    assert Counter(r["query"] for r in spark.read.parquet(f"{place['out']}/new").collect()) == Counter([*found, "q1"])


def test_streamed_means_equal_batch(spark, place):
    events = spark.read.parquet(f"{DATA}/sf0.001/events.parquet").orderBy("event_id").toPandas()
    for i in range(4):
        part = events.iloc[i::4]
        _feed(spark, place["in"], f"f{i}", [(f"SELECT {r.event_type}", float(r.value), str(r.ts)) for r in part.itertuples()])
    raw = M.executions(spark, place["in"], SCHEMA, files_per_poll=1)
    _drain(raw, M.keep_top(place["out"], 0.0, buckets=4, merge_every=2), place["check"])
    polls = spark.read.parquet(f"{place['out']}/top")
    last = polls.filter(c("batch_id") == polls.agg(F.max("batch_id")).first()[0]).collect()
    want = events.groupby("event_type").value.agg(["mean", "count"])
    assert {r.query[7:]: (round(r.mean_exec_time, 6), r.calls) for r in last} == {k: (round(m, 6), n) for k, m, n in want.itertuples()}
    assert polls.select("batch_id").distinct().count() == 4


def test_windows_count_late_and_open_rows(spark, place):
    rows = [("q", float(100 + m), f"2024-01-01 0{h}:{m:02d}:00") for h in range(5) for m in (0, 20, 40)]
    each = M.keep_parts(place["out"], lambda r: M.window_parts(r, "1 hour", 100.0))
    for name, part in (("a", rows), ("b", [("q", 500.0, "2024-01-01 00:30:00"), ("r", 1.0, "2024-01-09 00:00:00")]), ("c", [("q", 1.0, "2024-01-01 01:30:00")])):
        _feed(spark, place["in"], name, part)
        _drain(M.executions(spark, place["in"], SCHEMA), each, place["check"])
    want = [("2024-01-01 00:00:00", 4, 3), ("2024-01-01 01:00:00", 4, 2)] + [(f"2024-01-01 0{h}:00:00", 3, 2) for h in (2, 3, 4)] + [("2024-01-09 00:00:00", 1, 0)]
    assert sorted((str(r.start), r.n, r.slow) for r in M.slow_windows(spark, place["out"]).collect()) == want
    M.compact(spark, place["out"], ["start"], place["parts"])
    assert sorted((str(r.start), r.n, r.slow) for r in M.slow_windows(spark, place["parts"]).collect()) == want


def test_running_means_from_parts(spark, place):
    each = M.keep_parts(place["out"], M.mean_parts)
    for i, part in enumerate([[("q", 10.0), ("q", None), ("r", None)], [("q", 20.0)]]):
        each(spark.createDataFrame(part, "query string, ms double"), i)
    each(spark.createDataFrame([("q", 20.0)], "query string, ms double"), 1)  # a repeated poll
    assert {tuple(r) for r in M.running_means(spark, place["out"]).collect()} == {("q", 15.0, 3), ("r", None, 1)}


def test_files_split_over_tasks(spark, tmp_path):
    rows = spark.range(4000).select(c("id").cast("string").alias("Id"), F.lit("a & b").alias("DisplayName"), F.lit(None).cast("string").alias("Location"), F.lit("5").alias("Reputation"), F.lit("2010-07-19T06:55:26.860").alias("CreationDate"))
    files.write_dump(rows.coalesce(1), str(tmp_path / "dump"), "users")
    measured = spark.range(4000).select(*[(c("id") if f.name == "query_id" else F.lit("1")).cast(f.dataType).alias(f.name) for f in files.MEASUREMENT])
    files.append_measurements(measured.coalesce(1), str(tmp_path / "csv"), "csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        read = files.read_dump(spark, str(tmp_path / "dump"), "users")
        assert read.rdd.getNumPartitions() > 2 and read.count() == 4000
        assert spark.read.text(str(tmp_path / "csv")).rdd.getNumPartitions() > 2
        assert files.read_measurements(spark, str(tmp_path / "csv")).select("query_id").distinct().count() == 4000
        typed = files.accepted(files.typed(files.read_dump(spark, str(tmp_path / "dump"), "users"), "users"))
        assert typed.filter("display_name = 'a & b' and reputation = 5 and location is null").count() == 4000
        assert sorted(r.Id for r in read.collect()) == sorted(str(i) for i in range(4000))
        assert files.rejected_dump(spark, str(tmp_path / "dump"), "users").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_corrupt_records_are_set_aside(spark, tmp_path):
    path = tmp_path / "log"
    path.mkdir()
    (path / "a.json").write_text('{"type": "x", "query": "q"}\n{"type": "cut\n{"type": "y", "calls": "many"}\n')
    assert [r.type for r in files.read_log(spark, str(path)).collect()] == ["x"]
    assert sorted(r.raw for r in files.rejected_log(spark, str(path)).collect()) == ['{"type": "cut', '{"type": "y", "calls": "many"}']
    assert files.rejected_log(spark, str(tmp_path / "none")).collect() == []


def test_top_of_many_polls_keeps_bounded_candidates(spark, place):
    """Statements rise, fall and come back; a poll that is repeated counts once; what is ranked stays bounded."""
    import random

    rnd, sums, n, buckets = random.Random(1), {}, 3, 4
    each = M.keep_top(place["out"], 5.0, n=n, buckets=buckets, merge_every=3)
    for i in range(8):
        rows = [(f"SELECT {rnd.randrange(40)}", float(rnd.randrange(100))) for _ in range(25)] + [("SET x", 99.0), ("SELECT 1", None)]
        for q, ms in rows:
            sums.setdefault(q, []).append(ms)
        frame = spark.createDataFrame(rows, "query string, ms double")
        for _ in range(1 + (i % 3 == 2)):
            each(frame, i)
        means = {q: sum(x for x in v if x is not None) / k for q, v in sums.items() if (k := sum(x is not None for x in v))}
        want = sorted(((m, q) for q, m in means.items() if m > 5 and "SET" not in q), key=lambda x: (-x[0], x[1]))[:n]
        got = spark.read.parquet(f"{place['out']}/top/batch_id={i}").collect()
        assert sorted((round(r.mean_exec_time, 6), r["query"], r.calls) for r in got) == sorted((round(m, 6), q, len(sums[q])) for m, q in want)
        kept = spark.read.parquet(f"{place['out']}/best/batch_id={i}").select(F.inline("best"))
        assert kept.count() <= n * buckets


def _chain(spark, place, scorer, **changed):
    from slowtide.streaming import chain

    answers = lambda s: s.select("stmt", "query", "mean_exec_time", F.lit(0).alias("position"), F.lit("### Optimized Query\nSELECT id FROM t LIMIT 1").alias("raw"))
    plans = lambda rows: rows.withColumns({f: F.lit(0) for f in chain_features()})
    measured = lambda ranked: ranked.select("stmt", "sql", F.lit(3.0).alias("cold_ms"), F.lit(2.0).alias("warm_ms"), F.array(F.lit(2.0)).alias("all_runs_ms"))
    sources = {"answers": answers, "plans": plans, "measured": measured} | changed
    return chain.watch(place["out"], place["parts"], scorer, chain.Sources(**sources))


def chain_features():
    from slowtide.functions.plantree import PLAN_FEATURES

    return PLAN_FEATURES


def test_chain_sets_bad_statements_and_failed_stages_aside(spark, place):
    from slowtide.plans.fixtures import SCORER
    from slowtide.streaming import chain

    plan = '{"Plan": {"Node Type": "Seq Scan", "Total Cost": 500.0}}'
    rows = [
        ("a", "SELECT * FROM t", 90.0, 1, plan, [1.0, 0.0]), ("b", None, 90.0, 1, plan, [1.0, 0.0]), ("c", "SELECT * FROM u", -1.0, 1, plan, None),
        ("d", "SELECT * FROM v", 90.0, 1, '{"Plan": ', None), (None, "SELECT 1", 1.0, 1, plan, None), ("e", "SELECT * FROM w", 70.0, 1, None, None), ("f", "SELECT * FROM t", 80.0, 1, plan, [1.0, 0.1]),
    ]
    poll = spark.createDataFrame(rows, "stmt string, query string, mean_exec_time double, calls bigint, plan string, vector array<double>").withColumn("timestamp", F.lit("now"))
    each = _chain(spark, place, SCORER)
    each(poll, 0)
    events = {r.stmt: r for r in spark.read.parquet(f"{place['out']}/events").collect()}
    assert set(events) == {"a", "f"} and events["a"].measured_speedup_ms == 88.0 and not events["a"].similar_fix_used
    assert Counter((r.stmt, r.stage) for r in chain.quarantined(spark, place["out"]).collect()) == Counter([("b", "statement"), ("c", "statement"), (None, "statement"), ("d", "plan")])

    def down(_):
        raise ConnectionError("no answer")

    _chain(spark, place, SCORER, answers=down)(poll, 1)  # the source fails in one poll
    failed = [(r.stmt, r.stage, r.why) for r in chain.quarantined(spark, place["out"]).collect() if r.batch_id == 1 and r.stage.startswith("failed")]
    assert sorted(f[0] for f in failed) == ["a", "f"] and failed[0][1:] == ("failed_candidates", "ConnectionError: no answer")
    for _ in range(2):  # the stream goes on, with the fixes of the first poll; a repeated poll does not find its own
        each(poll, 2)
    last = spark.read.parquet(f"{place['out']}/handled/batch_id=2").collect()
    assert {r.stmt for r in last} == {"a", "f"} and all(r.similar_fix_used for r in last)
    assert files.read_history(spark, place["parts"]).count() == 4


def test_chain_deals_a_poll_over_the_cores_and_reads_each_plan_once(spark, place, monkeypatch):
    from slowtide.plans.fixtures import SCORER
    from slowtide.streaming import chain

    plan = '{"Plan": {"Node Type": "Seq Scan", "Total Cost": 500.0}}'
    rows = spark.range(0, 64, 1, 1).select(
        F.col("id").cast("string").alias("stmt"), F.concat(F.lit("SELECT * FROM t"), "id").alias("query"), F.lit(90.0).alias("mean_exec_time"), F.lit(1).alias("calls"),
        F.when(F.col("id") % 8 > 0, plan).otherwise("{").alias("plan"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("vector"), F.lit("now").alias("timestamp"),
    )
    rows.coalesce(1).write.parquet(f"{place['out']}-poll")
    poll, plans = spark.read.parquet(f"{place['out']}-poll"), []
    monkeypatch.setattr(chain, "write_batch", lambda rows, i, path, write=chain.write_batch: plans.append("EvalPython" in rows._jdf.queryExecution().executedPlan().toString()) or write(rows, i, path))
    _chain(spark, place, SCORER)(poll, 0)
    assert sum(plans) == 1
    assert Counter(r.stage for r in chain.quarantined(spark, place["out"]).collect()) == {"plan": 8}
    for stage in ("parsed", "features", "handled"):
        held = spark.read.parquet(f"{place['out']}/{stage}/batch_id=0")
        assert len(held.inputFiles()) > 1 and held.count() == (64 if stage == "parsed" else 56)


def test_runs_are_stored_once_for_all_polls(spark, monkeypatch):
    from slowtide.plans import fixtures

    kept = []
    monkeypatch.setattr(fixtures, "materialize", lambda df, label, write=fixtures.materialize: kept.append(label) or write(df, label))
    log = fixtures.Log(spark, f"{DATA}/sf0.001")
    ranked = log.stats.select("stmt", F.lit("SELECT id FROM posts WHERE score > 1 LIMIT 10").alias("sql"))
    first, second = log.measured_of(ranked).count(), log.measured_of(ranked.limit(1)).count()
    assert kept == ["runs"] and first == log.stats.count() * second


def test_repeated_poll_is_written_once(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (2,)], "x int")
    for _ in range(2):
        M.write_batch(rows, 3, str(tmp_path / "o"))
    M.write_batch(rows, 4, str(tmp_path / "o"))
    assert Counter(r.batch_id for r in spark.read.parquet(str(tmp_path / "o")).collect()) == {3: 2, 4: 2}


def test_dashboard_adds_up_polls(spark, place):
    from slowtide.operators.reports import dashboard_stats, normalise_log

    rows = [{"query": f"q{i}", "pg_stat_mean_ms": 10.0 * i, "model": {"p_slow": 0.1 * i}, "measured_speedup_ms": float(i - 2)} for i in range(9)]
    log = spark.createDataFrame(rows, files.EVENT)
    each = M.refresh(place["out"], place["parts"])
    each(log.filter("pg_stat_mean_ms < 40"), 0)
    each(log.filter("pg_stat_mean_ms >= 40"), 1)
    each(log.filter("pg_stat_mean_ms >= 40"), 1)
    assert M.dashboard(spark, place["parts"]).first() == dashboard_stats(normalise_log(log)).first()


def test_plain_elements_read_as_the_parser_reads_them(spark, tmp_path):
    """Elements without entities are cut by expressions; every row is read once, and as the XML parser reads it."""
    inside = [
        ' Id="1" DisplayName="a b" Location="x > y"', ' Id="2" DisplayName="a &amp; b"', ' Id="3" DisplayName=""', ' Id="4" DisplayName=" a "', " Id='5' DisplayName='q\"q'",
        ' Id="6" DisplayName="a" DisplayName="b"', ' Id="7" DisplayName="x Id= 9" Other="Id"', ' Id="8" DisplayName="tab\there"', ' Id="9" xmlns="u" DisplayName="n"', ' Id="10" a:b="c"',
        ' Id="11" DisplayName="\u00e9\u4e2d\U0001f600"', ' Id="12" DisplayName="a\u00a0"', ' MyId="13" Id="14"', ' Id = "15"', ' id="16"', ' Id="17" DisplayName="a&nbsp;b"', ' Id="18"DisplayName="b"', ' Id="19" DisplayName="null"', ' Id="20" DisplayName="a\x01b"', ' Id="21" 2x="b"',
    ]
    (tmp_path / "u.xml").write_text("<users>\n" + "\n".join(f"  <row{i} />" for i in inside) + "\n</users>")
    names = [a for a, *_ in files.DUMPS["users"]]
    schema = ", ".join(f"_{n} string" for n in names) + ", _broken string"
    raw = spark.createDataFrame([(f"<row{i} />",) for i in inside if re.fullmatch(files._ATTRIBUTES, i)], "x string")
    parsed = raw.select(F.from_xml("x", F.lit(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r")).filter("r._broken is null")
    order = lambda rows: sorted(map(tuple, rows), key=str)
    read = files.read_dump(spark, str(tmp_path / "u.xml"), "users")
    assert order(read.collect()) == order(parsed.select(*[f"r._{n}" for n in names]).collect())
    assert files.accepted(files.typed(read, "users"))._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1
