"""What operators share about the running session: checkpoints, table reading, per-worker state."""

from __future__ import annotations

import os
import sys
import tempfile
from typing import Any, Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for work that costs far more than moving its rows.

    A table of enough partitions, as any large one is, stays as it is: nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def work_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``table``, spread over the cores if it has fewer partitions than there are."""
    return spread(table(spark, folder, name))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and read it back.

    The folder is the one named in ``spark.checkpoint.dir``. Only a local session may name none: it gets a
    temporary folder. On a cluster that is an error, since executors would not share such a folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="examsift-checkpoint-"))
    return df.checkpoint(eager=True)


def worker_state(key: str, make: Callable[[], Any]) -> Any:
    """One object per Python worker process, kept between tasks."""
    kept = sys.__dict__.setdefault("_examsift_state", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
