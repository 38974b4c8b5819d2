"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))
#: Paths handed out by `scratch_path`, by application.
_written: dict[str, list[str]] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("slowtide")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    A session on one machine (`local[..]`) without that setting gets a temporary folder; on a cluster, whose
    machines do not share one, a missing setting is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="slowtide-"))
    return named or context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table below the shared folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Delete the tables this application has written below the shared folder; frames over them end with it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _written.pop(spark.sparkContext.applicationId, []):
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def materialize(df, label: str):
    """Write `df` once as Parquet in the shared folder and return a frame over the files.

    Later reads do not recompute the input, survive lost executors, and see one fixed answer.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark) -> None:
    """Give the executors this package, whatever folder the driver was started in (once a session)."""
    context = spark.sparkContext
    if getattr(context, "shipped_package__", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    context.addPyFile(path)
    context.shipped_package__ = True
