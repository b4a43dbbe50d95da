"""Session defaults and the shared folder that staged tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "longhouse", cpus: str | int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster use the session you are given."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": str(cpus) if str(cpus).isdigit() else "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # files of a few MB are cut into one split per core, as larger ones are by default
        "spark.sql.files.openCostInBytes": "262144",
        "spark.hadoop.parquet.block.size": "2097152",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may fall back to a folder of its own; on a cluster a machine-local
    folder would be lost with its executor, so a missing setting is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return os.path.join(tempfile.gettempdir(), "longhouse-checkpoints")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/longhouse/{label}-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged inside are deleted at the end; what is made of them must be written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def with_scratch(pipeline):
    """A pipeline over an archive, its first argument, that leaves no staged tables behind."""

    @wraps(pipeline)
    def run(archive, *args, **named):
        with scratch(archive.spark):
            return pipeline(archive, *args, **named)

    return run


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the written copy.

    Later jobs then see the same rows in the same files whatever happens to executors, and read
    only the columns they need, which a row-wise checkpoint would not allow. The copy belongs to
    the innermost ``scratch`` unless it is to be kept; outside of any it stays.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
