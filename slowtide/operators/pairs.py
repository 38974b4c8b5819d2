"""Preparing (slow, optimized) pairs and query tables: cleaning, resuming, splitting, sampling, scoring."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowtide.functions.text import ANSWER_MARK, clean_pair_text, is_candidate, strip
from slowtide.operators.ordered import positions
from slowtide.operators.runs import first_seen
from slowtide.session import ship
from slowtide.sources.files import DUMPS

_SQL_TYPES = {"int": "INT", "string": "TEXT", "timestamp_ntz": "TIMESTAMP"}
# what a prompt says about the tables, from the columns they really have
PROMPT_SCHEMA = "\n".join(
    f"CREATE TABLE {table} ({', '.join(f'{name} {_SQL_TYPES[kind]}' for _, name, kind, _ in columns)});" for table, columns in sorted(DUMPS.items())
)


def clean_pairs(pairs: DataFrame) -> DataFrame:
    """Cleaned pairs with `changed` (cleaning altered a side) and `kept` (the rewrite is still a query)."""
    slow, optimized = clean_pair_text(F.col("slow")), clean_pair_text(F.col("optimized"))
    return pairs.withColumns(
        {
            "changed": (slow != F.col("slow")) | (optimized != F.col("optimized")),
            "kept": is_candidate(optimized),
            "slow": slow,
            "optimized": optimized,
        }
    )


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """Pairs before and after; `fixed` also counts changed pairs that were then removed."""
    return cleaned.agg(
        F.count("*").alias("before"),
        F.count_if("changed").alias("fixed"),
        F.count_if(~F.col("kept")).alias("removed"),
        F.count_if("kept").alias("after"),
    )


def pending(measured: DataFrame, pairs: DataFrame) -> DataFrame:
    """Slow queries that have no pair yet; repeated queries stay repeated."""
    done = pairs.select("slow").distinct()
    return measured.filter(F.col("label") == "slow").join(done, F.col("query_text") == F.col("slow"), "left_anti")


def new_queries(generated: DataFrame, existing: DataFrame, position: str) -> DataFrame:
    """Generated queries whose trimmed text is new; the first of equal texts stays."""
    trimmed = generated.withColumn("trimmed__", strip(F.col("query_text")))
    known = existing.select(strip(F.col("query_text")).alias("known__")).distinct()
    fresh = trimmed.join(known, F.col("trimmed__") == F.col("known__"), "left_anti")
    return first_seen(fresh, F.col("trimmed__"), [F.col(position)]).drop("trimmed__")


def continue_ids(new_rows: DataFrame, existing: DataFrame, order: Sequence[Column], name: str = "query_id") -> DataFrame:
    """Number new rows after the last id in use."""
    last = existing.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint")).scalar()
    placed = positions(new_rows, [], order, "place__")
    return placed.withColumn(name, F.col("place__") + last).drop("place__")


def insert_absent(batch: DataFrame, target: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The rows an INSERT .. ON CONFLICT DO NOTHING adds: new keys, first row of each."""
    taken = target.select(F.col(key).alias("taken__")).distinct()
    fresh = batch.join(taken, F.col(key) == F.col("taken__"), "left_anti")
    return first_seen(fresh, F.col(key), order)


def prompts(pairs: DataFrame, fixes: DataFrame | None = None, key: str = "pair_id") -> DataFrame:
    """`prompt` and `target` per pair; `fixes` (key, slow_query, fix, speedup_ms) adds the nearest past fix."""
    slow = strip(F.col("slow"))
    # fixed values: the headings of the prompt
    context = F.lit(PROMPT_SCHEMA)
    if fixes is not None:
        pairs = pairs.join(fixes, key, "left")
        hint = F.concat(
            F.lit("\n\nA similar slow query was previously fixed:\nSlow: "), F.col("slow_query"),
            F.lit("\nFix: "), F.col("fix"), F.lit("\nSpeedup: "), F.col("speedup_ms").cast("string"), F.lit("ms\n"),
        )
        context = F.concat(context, F.coalesce(hint, F.lit("")))
    prompt = F.concat(
        F.lit("### Task\nRewrite the following slow PostgreSQL query to be faster.\n\n### Database Schema\n"),
        context,
        F.lit("\n\n### Slow Query\n"), slow, F.lit(f"\n\n{ANSWER_MARK}\n"),
    )
    return pairs.select(key, prompt.alias("prompt"), strip(F.col("optimized")).alias("target"))


def seeded_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def split_rows(df: DataFrame, key: str, seed: int, held_out: float, name: str = "split", strata: str | None = None) -> DataFrame:
    """A repeatable train/validation split of exact size, per stratum if one is named.

    `key` is unique. Rows are placed in the order of a seeded hash; floor(held_out * n) of them go
    to validation.
    """
    keys = [strata] if strata else []
    placed = positions(df.withColumn("hash__", seeded_hash(F.col(key), seed)), keys, [F.col("hash__"), F.col(key)], "place__")
    if strata:
        sizes = df.groupBy(F.col(strata).alias("stratum__")).agg(F.count("*").alias("rows__"))
        sized = placed.join(sizes, F.col(strata).eqNullSafe(F.col("stratum__"))).drop("stratum__")
    else:
        sized = placed.withColumn("rows__", df.agg(F.count("*")).scalar())
    held = F.col("place__") <= F.floor(F.col("rows__") * held_out)
    return sized.withColumn(name, F.when(held, "val").otherwise("train")).drop("place__", "rows__", "hash__")


def sample_per_stratum(df: DataFrame, stratum: Column, key: str, seed: int, n: int) -> DataFrame:
    """n rows of each stratum (all if there are fewer) by seeded hash; NULL strata are left out."""
    tagged = df.withColumn("stratum", stratum).filter("stratum IS NOT NULL")
    order = Window.partitionBy("stratum").orderBy(seeded_hash(F.col(key), seed), F.col(key))
    return tagged.withColumn("nth__", F.row_number().over(order)).filter(F.col("nth__") <= n).drop("nth__")


def spot_check_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """Half slow and half fast rows; fast rows fill up when there are too few slow ones."""
    drawn = sample_per_stratum(df, F.col("label"), key, seed, n).withColumn(
        "nth__",
        F.row_number().over(Window.partitionBy("label").orderBy(seeded_hash(F.col(key), seed), F.col(key))),
    )
    slow = F.least(df.agg(F.count_if(F.col("label") == "slow")).scalar(), F.lit(n // 2))
    return drawn.filter(F.col("nth__") <= F.when(F.col("label") == "slow", slow).otherwise(F.lit(n) - slow)).drop("nth__", "stratum")


def severity(warm_ms: Column, label: Column, timed_out: Column, low: float = 100.0, high: float = 500.0) -> Column:
    """moderate or severe for slow statements without time-outs, else NULL."""
    usable = (label == "slow") & (timed_out == 0)
    return F.when(usable & (warm_ms >= high), "severe").when(usable & (warm_ms >= low), "moderate")


def tokens_13a(text: Column) -> Column:
    """The mteval-v13a tokenisation: punctuation and symbols apart, numbers kept whole."""
    out = F.replace(text, F.lit("<skipped>"), F.lit(""))
    out = F.replace(F.replace(out, F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))
    # Entities and the four splitting patterns of the tokeniser.
    for entity, plain in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(entity), F.lit(plain))
    out = F.concat(F.lit(" "), out, F.lit(" "))
    out = F.regexp_replace(out, r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 ")
    out = F.regexp_replace(out, r"([^0-9])([\.,])", "$1 $2 ")
    out = F.regexp_replace(out, r"([\.,])([^0-9])", " $1 $2")
    out = F.regexp_replace(out, r"([0-9])(-)", "$1 $2 ")
    return F.filter(F.split(out, r"\s+"), lambda t: t != "")


def _gram_counts(batches):
    """Per batch and split: clipped and predicted 1- to 4-grams, and the expected words, of the keys that end in it."""
    import pyarrow as pa

    names = ["split__", *[f"c{n}" for n in range(1, 5)], *[f"t{n}" for n in range(1, 5)], "ref_len"]
    held, kind, p, e = None, None, [Counter()], [Counter()]

    def close(sums):
        if any(p) or any(e):
            now = [sum((x & y).values()) for x, y in zip(p, e, strict=True)] + [x.total() for x in p] + [e[0].total()]
            sums[held[1]] = [x + y for x, y in zip(sums.get(held[1], [0] * 9), now, strict=True)]

    def batch_of(sums):
        told = list(zip(*[(s, *v) for s, v in sums.items()], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, kind if i == 0 else pa.int64()) for i, c in enumerate(told)], names=names)

    for batch in batches:
        sums, kind = {}, batch.schema.field("split__").type
        for *now, said, meant in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if now != held:
                close(sums)
                held, p, e = now, [Counter() for _ in range(4)], [Counter() for _ in range(4)]
            for counts, words in ((p, said or []), (e, meant or [])):
                for n, counter in enumerate(counts, 1):
                    counter.update(zip(*[words[i:] for i in range(n)]))
        if sums:
            yield batch_of(sums)
    sums = {}
    close(sums)
    if sums:
        yield batch_of(sums)


def corpus_bleu(df: DataFrame, key: str, predicted: str, expected: str, split: str) -> DataFrame:
    """Corpus BLEU per split: clipped 1- to 4-grams, brevity penalty, exponential smoothing.

    Texts are spread and ordered by `key`, and their n-grams counted where they lie; rows of one key and split count
    as one text. Only the sums of each batch go on. A text that is null has no words.
    """
    ship(df.sparkSession)
    spread = df.select(key, split, tokens_13a(F.col(predicted)).alias("p"), tokens_13a(F.col(expected)).alias("e"))
    ordered = spread.repartition(key).sortWithinPartitions(key, split)
    names = [*[f"c{n}" for n in range(1, 5)], *[f"t{n}" for n in range(1, 5)], "ref_len"]
    schema = T.StructType([T.StructField("split__", df.schema[split].dataType), *[T.StructField(n, T.LongType()) for n in names]])
    parts = ordered.select(key, F.col(split).alias("split__"), "p", "e").mapInArrow(_gram_counts, schema)
    sums = parts.groupBy(F.col("split__").alias(split)).agg(*[F.sum(n).alias(n) for n in names])
    zeros = F.lit(0)
    logs = F.lit(0.0)
    for n in range(1, 5):
        hit, total = F.col(f"c{n}"), F.col(f"t{n}")
        zeros = zeros + (hit == 0).cast("int")
        part = F.when(hit > 0, hit / total).otherwise(F.try_divide(F.lit(1.0), F.pow(F.lit(2.0), zeros) * total))
        logs = logs + F.ln(part)
    penalty = F.when(F.col("t1") >= F.col("ref_len"), 1.0).otherwise(
        F.exp(1 - F.try_divide(F.col("ref_len").cast("double"), F.col("t1")))
    )
    bleu = F.when(F.col("c1") + F.col("c2") + F.col("c3") + F.col("c4") == 0, 0.0).otherwise(
        F.coalesce(penalty * F.exp(logs / 4) * 100, F.lit(0.0))
    )
    return sums.select(split, bleu.alias("bleu"))
