"""Readers and writers of the files the workload exchanges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowtide.functions.plantree import PLAN_FEATURES
from slowtide.functions.text import TEXT_FEATURES
from slowtide.session import materialize, ship

# Dump attributes, target columns, types, and the default of a missing attribute.
DUMPS: dict[str, list[tuple[str, str, str, str | None]]] = {
    "users": [
        ("Id", "id", "int", None), ("DisplayName", "display_name", "string", None), ("Location", "location", "string", None),
        ("Reputation", "reputation", "int", "0"), ("CreationDate", "creation_date", "timestamp_ntz", None),
    ],
    "posts": [
        ("Id", "id", "int", None), ("PostTypeId", "post_type_id", "int", None), ("OwnerUserId", "owner_user_id", "int", None),
        ("Title", "title", "string", None), ("Score", "score", "int", "0"), ("ViewCount", "view_count", "int", "0"),
        ("AnswerCount", "answer_count", "int", "0"), ("CreationDate", "creation_date", "timestamp_ntz", None),
    ],
    "votes": [
        ("Id", "id", "int", None), ("PostId", "post_id", "int", None), ("VoteTypeId", "vote_type_id", "int", None),
        ("CreationDate", "creation_date", "timestamp_ntz", None),
    ],
}
# The 28 columns of a measurement, in file order.
MEASUREMENT = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("query_text", T.StringType()),
        T.StructField("execution_time_cold_ms", T.DoubleType()),
        T.StructField("execution_time_warm_ms", T.DoubleType()),
        T.StructField("execution_time_warm_std_ms", T.DoubleType()),
        T.StructField("all_runs_ms", T.StringType()),
        T.StructField("timed_out_runs", T.IntegerType()),
        T.StructField("label", T.StringType()),
        *[T.StructField(f, T.IntegerType()) for f in TEXT_FEATURES],
        *[
            T.StructField(
                f,
                T.DoubleType() if f == "plan_total_cost" else T.IntegerType() if f.startswith("has_") or f == "plan_depth" else T.LongType(),
            )
            for f in PLAN_FEATURES
        ],
    ]
)
EVENT = (
    "type string, timestamp string, query string, pg_stat_mean_ms double, calls bigint, "
    "model struct<p_slow:double,predicted_ms:double,plan_total_cost:double,has_seq_scan:int,has_index_scan:int>, "
    "p_slow double, predicted_ms double, reason string, index_suggestion string, llm_source string, similar_fix_used boolean, "
    "candidates_ranked array<struct<sql:string,strategy:string,predicted_ms:double,predicted_speedup_ms:double>>, "
    "top_candidate_verified struct<cold_ms:double,warm_median_ms:double,all_runs_ms:array<double>>, measured_speedup_ms double, "
    "avg_time_ms double, confidence double, fix string, speedup_ms double, flagged boolean"
)
RUN_RESULT = (
    "query string, pattern string, pg_stat_mean_ms double, model_p_slow double, model_predicted_ms double, "
    "candidates_generated int, top_candidate_sql string, strategy string, verified_cold_ms double, "
    "verified_warm_median_ms double, measured_speedup_ms double, speedup_factor double, result string, "
    "similar_fix_found boolean, similar_fix_similarity double, note string"
)
PAIR = "slow string, optimized string"
HISTORY = "entry_id bigint, slow_query string, fix string, speedup_ms double, vector array<float>"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


# ---- XML dumps


# A "<" cannot stand in an attribute value, so this mark begins an element wherever it stands, whatever the lines are.
_MARK = "<row"
_ATTRIBUTES = r"""(?:\s+[\w:.-]+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*\s*"""
_ELEMENT = rf"\A({_ATTRIBUTES})/?>"
# an element whose attributes read as they stand: plain names, no two alike, and values in double quotes without entities,
# control characters or spaces at their ends; any other element is left to the XML parser
_VISIBLE = r"!#-%'-;=-~\u00A1-\u167F\u1681-\u1FFF\u2070-\u2FFF\u3001-\uD7FF\uF900-\uFDCF\uFDF0-\uFEFE\uFF01-\uFFEF"
_PLAIN = rf'\A(?:\s+(?!(?i:xml))[A-Za-z_]\w*="[{_VISIBLE}](?:[{_VISIBLE} ]*[{_VISIBLE}])?")*\s*/?>'
_TWICE = r'\s(\w+)="(?:[^>]*\s)?\1="'
# what may lie between elements: the end of a longer tag name, then declarations, comments, tags and white space
_BETWEEN = r"\A(?:[\w:.-][^<>]*>)?(?:\s+|\uFEFF|<\?[^?]*\?>|<!--(?:[^-]|-(?!->))*-->|<!\w[^>]*>|</?[\w:.-]+[^<>]*>)*\z"


def _dump_pieces(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Per piece of a dump from one element to the next: `r` (the attributes, null if it is no element), and `left`, its
    text apart from a whole element."""
    schema = ", ".join(f"_{attribute} string" for attribute, *_ in DUMPS[table]) + ", _broken string"
    piece = F.col("value")
    element = piece.rlike(_ELEMENT)
    inside = F.concat(F.lit(_MARK), F.regexp_extract(piece, _ELEMENT, 1), F.lit("/>"))
    parsed = F.from_xml(F.when(element, inside), F.lit(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    values = [F.nullif(F.regexp_extract(piece, rf'\s{attribute}="([^"]*)"', 1), F.lit("")).alias(f"_{attribute}") for attribute, *_ in DUMPS[table]]
    named = "|".join(attribute for attribute, *_ in DUMPS[table])
    # names in another case are the parser's too
    plain = piece.rlike(_PLAIN) & ~piece.rlike(_TWICE) & ~piece.rlike(rf'\s(?!(?:{named})=)(?i:{named})="')
    read = F.when(plain, F.struct(*values, F.lit(None).cast("string").alias("_broken"))).otherwise(parsed)
    # a generated row is computed once, however many columns and filters read it
    rows = spark.read.option("lineSep", _MARK).text(path).select("value", F.explode(F.array(read)).alias("r"))
    whole = F.col("r").isNotNull() & F.col("r._broken").isNull()
    left = F.when(whole, F.regexp_replace(piece, _ELEMENT, "")).otherwise(piece)
    return rows.select(F.when(whole, F.col("r")).alias("r"), left.alias("left"), whole.alias("whole"))


def read_dump(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One row of strings per <row> element; an absent attribute is NULL.

    Files are cut at the mark that opens an element, so they split over many tasks, and elements may share a line, be
    indented in any way or span lines. `rejected_dump` has all that is no element.
    """
    rows = _dump_pieces(spark, path, table).filter("whole")
    return rows.select(*[F.col(f"r._{attribute}").alias(attribute) for attribute, *_ in DUMPS[table]])


def rejected_dump(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The text (`raw`) of damaged elements and of whatever else lies between elements and is no markup."""
    rows = _dump_pieces(spark, path, table).filter(~F.col("left").rlike(_BETWEEN))
    return rows.select(F.trim(F.when(F.col("whole"), F.col("left")).otherwise(F.concat(F.lit(_MARK), "left")), F.lit(" \t\r\n")).alias("raw"))


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Target columns, plus `rejected`: the id is missing or some attribute does not convert."""
    bad = F.col("Id").isNull()
    columns = []
    for attribute, name, kind, default in DUMPS[table]:
        given = F.col(attribute) if default is None else F.coalesce(F.col(attribute), F.lit(default))
        value = given.try_cast(kind)
        bad = bad | (given.isNotNull() & value.isNull())
        columns.append(value.alias(name))
    return raw.select(*columns, bad.alias("rejected"), F.struct(*raw.columns).alias("raw"))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("rejected")).drop("rejected", "raw")


def quarantined(rows: DataFrame) -> DataFrame:
    """The rejected rows as they were read."""
    return rows.filter("rejected").select("raw.*")


# ---- measurement tables


def _joined(batches):
    """Records of the lines of each slice, in order: whole ones, and the fragments at the slice's ends.

    `part` is 0 for a whole record, 1 for one that goes on in the next slice, 2 for what continues from an earlier one
    and ends here, 3 for a slice inside one record. The first record of a file is its header.
    """
    import pyarrow as pa

    names = ["file", "block", "part", "record"]
    slice_, held, open_, begun = None, [], False, False
    first = True

    def close(file, block, ended):
        part = (0 if ended else 1) if begun else (2 if ended else 3)
        return file, block, part, "\n".join(held)

    for batch in batches:
        out = []
        for value, file, block, inside in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if (file, block) != slice_:
                if held:
                    out.append(close(*slice_, False))
                slice_, held, open_, begun = (file, block), [], inside, not inside
                first = block == 0
            held.append(value)
            open_ ^= value.count('"') % 2 == 1
            if not open_:
                if not first:
                    out.append(close(file, block, True))
                first, held, begun = False, [], True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)], names=names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(close(*slice_, False), (pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)], names=names)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """The records (`record`) of CSV files without their headers; a quoted field may span lines.

    Files split: each slice's number of quotes is counted, the parity of those before a slice in its file says whether it
    begins inside a field (a table of one row per slice), and lines are joined within slices. Only fragments at the ends
    of slices are gathered.
    """
    ship(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    slices = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = slices.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")).filter("inside")
    told = lines.join(F.broadcast(inside), ["file", "block"], "left").select("value", "file", "block", F.coalesce("inside", F.lit(False)).alias("inside"))
    pieces = materialize(told.mapInArrow(_joined, "file string, block bigint, part int, record string"), "records")
    # at most two fragments a slice; those of one record follow each other
    upto = Window.partitionBy("file").orderBy("block", F.col("part") == 1)
    fragments = pieces.filter("part > 0").withColumn("begun", F.count_if(F.col("part") == 1).over(upto))
    spanning = fragments.groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts")).select(F.array_join("parts.record", "\n").alias("record"))
    return pieces.filter("part = 0").select("record").union(spanning)


def _measured(spark: SparkSession, path: str) -> DataFrame:
    record = F.regexp_replace("record", r"\r\z", "")
    schema = f"{MEASUREMENT.simpleString()[7:-1].replace(':', ' ')}, _corrupt string"
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "multiLine": "true"}
    rows = quoted_records(spark, path).filter(F.trim("record", F.lit(" \t\r")) != "")
    return rows.select(record.alias("raw"), F.from_csv(record, schema, options).alias("r"))


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """The records of measurement CSV files; `rejected_measurements` has those with a cell that is none of its kind."""
    return _measured(spark, path).filter("r._corrupt is null").select(*[F.col(f"r.{f.name}").alias(f.name) for f in MEASUREMENT.fields])


def rejected_measurements(spark: SparkSession, path: str) -> DataFrame:
    """The text (`raw`) of every record that `read_measurements` leaves out."""
    return _measured(spark, path).filter("r._corrupt is not null").select("raw")


def append_measurements(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append in the fixed column order, whatever order the frame has."""
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MEASUREMENT.fields]).write.mode("append")
    if fmt == "csv":
        out.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    else:
        out.format(fmt).save(path)


# ---- JSON logs, pairs, run results, history


def _marked_json(spark: SparkSession, path: str, schema: str, lines: bool) -> DataFrame:
    full = f"{schema}, _corrupt string"
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).option("columnNameOfCorruptRecord", "_corrupt").option("multiLine", not lines).json(path)
    # always true; it has every column parsed, so a corrupt record is found whatever a query reads
    parsed = F.hash(*[c for c in rows.columns if c != "_corrupt"]) >= F.lit(-(2**31))
    return rows.filter(parsed)


def read_json(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    """Records of a JSON file or folder; an absent path gives no rows. `rejected_json` has the corrupt records.

    `lines=False` reads one JSON array per file.
    """
    return _marked_json(spark, path, schema, lines).filter(F.col("_corrupt").isNull()).drop("_corrupt")


def rejected_json(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    """The text (`raw`) of every corrupt record that `read_json` leaves out."""
    return _marked_json(spark, path, schema, lines).filter(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("raw"))


def rejected_log(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    return rejected_json(spark, path, EVENT, lines)


def read_log(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    return read_json(spark, path, EVENT, lines)


def append_log(events: DataFrame, path: str) -> None:
    """Append events as JSON lines; nothing already written is touched."""
    events.write.mode("append").json(path)


def read_pairs(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    return read_json(spark, path, PAIR, lines)


def write_pairs(pairs: DataFrame, path: str) -> None:
    pairs.select("slow", "optimized").write.mode("overwrite").json(path)


def read_run_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return read_json(spark, path, RUN_RESULT, lines)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Past fixes; empty before the first one is stored."""
    if not exists(spark, path):
        return spark.createDataFrame([], HISTORY)
    return spark.read.schema(HISTORY).parquet(path)


def append_history(fixes: DataFrame, path: str) -> None:
    fixes.select(*[c.split()[0] for c in HISTORY.split(", ")]).write.mode("append").parquet(path)


def write_evaluation(rows: DataFrame, summary: DataFrame, path: str) -> None:
    """Per-statement rows as CSV and the summary as JSON below one path."""
    rows.write.mode("overwrite").csv(f"{path}/rows", header=True, escape='"')
    summary.write.mode("overwrite").json(f"{path}/summary")


def dump_attribute(column: Column) -> Column:
    """How a value is written into a dump attribute."""
    return column.cast("string")


def write_dump(df: DataFrame, path: str, table: str) -> None:
    """Write rows with attribute names as columns in the form of a dump."""
    attributes = [attribute for attribute, *_ in DUMPS[table]]
    named = df.select(*[dump_attribute(F.col(a)).alias(f"_{a}") for a in attributes])
    named.write.format("xml").option("rootTag", table).option("rowTag", "row").save(path)
