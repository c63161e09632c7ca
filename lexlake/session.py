"""Session helpers shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes df to the cluster's checkpoint folder and reads it from there.

    The folder is the one in spark.checkpoint.dir. Where that is unset a local master, as in tests,
    gets a folder of its own; a cluster is refused, as its executors share no folder of a machine.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir") or df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is not set")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()
