"""JSON lines, reports and evaluation files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line, blank lines passed over; a missing path is an empty table, a bad line raises when read."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def write_jsonl(rows: DataFrame, path: str, append: bool = False, order: list[str] | None = None) -> None:
    """UTF-8 lines with ISO timestamps, sorted across files where an order is given."""
    rows = rows.orderBy(*order) if order else rows
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A report (small, on the driver) as one indented JSON object, by Spark's file systems."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, True)
    out.write(bytearray(json.dumps(report, indent=2, ensure_ascii=False, default=str).encode()))
    out.close()


def read_eval(spark: SparkSession, path: str) -> DataFrame:
    """query, expected_urls from a JSON array."""
    return spark.read.option("multiLine", True).schema("query string, expected_urls array<string>").json(path).filter(F.col("query").isNotNull())
