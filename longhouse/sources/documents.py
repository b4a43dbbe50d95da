"""Documents as base64 text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNKED = "spark.sql.chunkBase64String.enabled"


def base64_text(content: Column) -> Column:
    """Base64 on one line (operator H-9), whatever the session says about line breaks."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def read_documents(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """(name, document) of the named files, whole and base64-encoded (operator A-2)."""
    paths = [f"{folder}/{n}" for n in dict.fromkeys(names)]
    if not paths:
        return spark.createDataFrame([], "name string, document string")
    for path in paths:
        if not path_exists(spark, path):
            raise FileNotFoundError(f"there is no file {path}")
    literal = [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]
    files = spark.read.format("binaryFile").load(literal)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        base64_text(F.col("content")).alias("document"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
