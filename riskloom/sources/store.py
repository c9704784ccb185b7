"""Sinks: cached intermediates, the feature matrix, predictions and metrics."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import named
from riskloom.operators.checks import Observed
from riskloom.operators.shape import sorted_columns
from riskloom.session import exists, file_states, remove


class Cache:
    """Named intermediate tables in a shared folder, rebuilt when asked or when what they were built from has changed.

    ``refresh`` is "all", or the names to rebuild (a collection, or one text that
    contains them).  Everything else is read back, if its write was finished and its manifest, written last, agrees: the files
    that the part is built from with their sizes and times, the code that builds it, and the schema.  ``rows`` has the
    rows of each part, counted while it was written.  Reading back also cuts the lineage, so a lost executor costs a
    re-read and not a rebuild of the chain.
    """

    def __init__(self, spark: SparkSession, folder: str, refresh: str | Sequence[str] = "all"):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.refresh = refresh
        self.rows: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def _wanted(self, name: str) -> bool:
        return self.refresh == "all" or name in self.refresh

    def table(self, name: str, build: Callable[[], DataFrame], inputs: Sequence[DataFrame] = (), code: str = "") -> DataFrame:
        """The part; ``inputs`` are the tables that it is built from and ``code`` stands for how."""
        manifest = f"{self.folder}/{name}.manifest"
        made_from = {"files": sorted({f for df in inputs for f in file_states(self.spark, df.inputFiles())}), "code": code}
        if not self._wanted(name) and exists(self.spark, f"{manifest}/_SUCCESS"):
            known = json.loads(self.spark.read.text(manifest).first()["value"])
            found = self.spark.read.parquet(self.path(name))
            if known["from"] == made_from and known["schema"] == _shape(found):
                self.rows[name] = known["rows"]
                return found
        remove(self.spark, manifest)
        made = Observed(build(), name)
        made.rows.write.mode("overwrite").parquet(self.path(name))
        found = self.spark.read.parquet(self.path(name))
        self.rows[name] = made.count()
        note = json.dumps({"from": made_from, "schema": _shape(found), "rows": self.rows[name]})
        self.spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(manifest)
        return found


def _shape(df: DataFrame) -> list[str]:
    return [f"{name} {kind}" for name, kind in df.dtypes]


def write_matrix(df: DataFrame, path: str) -> None:
    """The feature matrix, columns in sorted order."""
    sorted_columns(df).write.mode("overwrite").parquet(path)


def sample_rows(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The first n rows by key."""
    return df.orderBy(named(key)).limit(n)


def write_sample(df: DataFrame, key: str, path: str, n: int = 100) -> None:
    sample_rows(sorted_columns(df), key, n).write.mode("overwrite").csv(path, header=True)


def write_predictions(df: DataFrame, key: str, prediction: str, path: str, format: str = "csv", as_name: str = "TARGET") -> None:
    """Predictions always carry their key; row position means nothing here."""
    out = df.select(named(key), named(prediction).alias(as_name)).write.mode("overwrite")
    if format == "csv":
        out.csv(path, header=True)
    else:
        out.parquet(path)


def fill_template(spark: SparkSession, template: str, predictions: DataFrame, key: str, column: str = "TARGET") -> DataFrame:
    """A submission template with its prediction column filled in by key."""
    ids = spark.read.csv(template, header=True, schema=f"{key} bigint, {column} double").select(key)
    return ids.join(predictions.select(key, column), [key], "left")


def log_metrics(spark: SparkSession, path: str, experiment: str, values: dict[str, float], note: str = "") -> None:
    """Append one experiment's metrics, one row per metric."""
    rows = [(experiment, name, float(value), note) for name, value in values.items()]
    frame = spark.createDataFrame(rows, "experiment string, metric string, value double, note string")
    frame.coalesce(1).withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
