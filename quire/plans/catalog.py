"""The list that queries and their SQL equivalents are entered in, and inline fixtures for both engines."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Enter a query under an inventory number and name, with the SQL that gives the same rows."""

    def enter(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is there already")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return enter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, kind: str) -> str:
    """A new folder that all executors share, below the one the session names; it is removed when the driver ends."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if root is None:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quire-")
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{root}/quire-{kind}-{uuid.uuid4().hex}")
    files = path.getFileSystem(sc._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return path.toString()


class Fixture:
    """Rows that both engines read: a DataFrame here, a VALUES list there."""

    def __init__(self, schema: str, rows: list[tuple]) -> None:
        self.schema, self.rows = schema, rows
        self.columns = [c.split()[0] for c in schema.split(", ")]
        self.kinds = [c.split(maxsplit=1)[1] for c in schema.split(", ")]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.schema)

    def sql(self) -> str:
        kinds = {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}
        rows = ", ".join("(" + ", ".join(f"CAST({_literal(v)} AS {kinds[k]})" for v, k in zip(row, self.kinds, strict=True)) + ")" for row in self.rows)
        names = ", ".join(f'"{c}"' for c in self.columns)
        return f"(SELECT * FROM (VALUES {rows}) AS v({names}))"


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, list):
        return "[" + ", ".join(map(_literal, value)) + "]"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)
