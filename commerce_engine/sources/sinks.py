"""Writers: stage tables, report files and the dashboard document."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import decimals_to_double


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write a stage as Parquet and return it as read back.

    With a partition column the rows are rebalanced on it first: each directory
    gets a few files of good size, and a directory holding most of the rows is
    still written by many tasks.
    """
    _save(_spread(df, partition_by), path, partition_by)
    return df.sparkSession.read.parquet(path)


def _spread(df: DataFrame, partition_by: str | None) -> DataFrame:
    return df.hint("rebalance", F.col(partition_by)) if partition_by else df


def _save(df: DataFrame, path: str, partition_by: str | None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_observed(df: DataFrame, path: str, metrics: Mapping[str, Column], partition_by: str | None = None) -> tuple[DataFrame, dict]:
    """As :func:`write_table`, with aggregates of the rows taken on their way into the table.

    They are taken in the writing stage, behind the last shuffle: its tasks count once,
    however often earlier stages are run again for lost executors.
    """
    seen = Observation()
    watched = _spread(df, partition_by).observe(seen, *[v.alias(k) for k, v in metrics.items()])
    _save(watched, path, partition_by)
    return df.sparkSession.read.parquet(path), seen.get


def write_report(df: DataFrame, path: str) -> None:
    """A small aggregate as one CSV file with a header."""
    decimals_to_double(df).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_document(payload: DataFrame, path: str) -> None:
    """A one-row, one-column JSON payload as one text file."""
    payload.coalesce(1).write.mode("overwrite").text(path)


def write_reports(results: Mapping[str, DataFrame], folder: str) -> None:
    """One result folder per named query."""
    for name, df in results.items():
        write_report(df, f"{folder}/{name}")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
