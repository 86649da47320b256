"""Sinks (S5-S9): every job ends in exactly one of these writes.

Writes go through Spark's commit protocol, so a lost executor re-runs its
tasks and a failed job leaves no partial output behind.  Intermediate
tables that cut long lineages go to the shared checkpoint folder named by
``spark.checkpoint.dir`` (see :func:`cut_lineage`).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_run_date
from ..session import checkpoint_path


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """Overwrite a parquet table (S5); with ``partition_by`` only the
    partitions present in ``df`` are replaced (S8, dynamic overwrite)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_files(df: DataFrame, path: str, n_files: int, keys: Sequence[str] = ()) -> None:
    """Write ``n_files`` files (S6): hash-partitioned on ``keys`` when given,
    else round-robin — which Spark sorts first, so a retried stage after a
    lost executor hands every row to the same file again."""
    out = df.repartition(n_files, *keys) if keys else df.repartition(n_files)
    out.write.mode("overwrite").parquet(path)


def with_run_date(df: DataFrame, run_date: str | None = None) -> DataFrame:
    """Add the ``run_date`` partition column, ``yyyyMMdd``."""
    value = F.lit(run_date) if run_date else format_run_date()
    return df.withColumn("run_date", value)


def split_quarantine(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Rows meeting ``ok`` and the rest, kept apart."""
    cond = F.coalesce(ok, F.lit(False))
    return df.filter(cond), df.filter(~cond)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Used between long job stages: a lost executor then re-reads this table
    instead of recomputing the whole upstream plan.
    """
    path = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_observed(df: DataFrame, path: str, name: str, metrics: dict[str, Column],
                   partition_by: Sequence[str] | None = None) -> dict:
    """Write ``df`` and collect ``metrics`` (aggregate expressions) from the
    same action with ``DataFrame.observe`` — counters without a second pass
    over the data (A15)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    observed = df.observe(obs, *[expr.alias(k) for k, expr in metrics.items()])
    write_table(observed, path, partition_by)
    return obs.get
