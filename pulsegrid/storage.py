"""Where intermediate tables stand."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder ``spark.checkpoint.dir`` names; lost executors do not lose it.

    Where the setting is empty, a temporary folder of this machine is taken, and only if all runs here.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if not folder and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-ckpt-"))
    return df.checkpoint(eager=True)
