"""Where core operators cut their lineage: checkpoints in the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` run once into the shared checkpoint folder; a temporary folder only where none is set and all runs on this machine."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir has to name a folder that all machines of the cluster share")
            folder = "file://" + tempfile.mkdtemp(prefix="trackloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
