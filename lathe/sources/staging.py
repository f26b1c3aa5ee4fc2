"""Tables written to the folder that driver and executors share, and the package on the workers' path."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The folder that holds the package; Python workers need it on their path.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(df: DataFrame) -> SparkSession:
    """The session of a frame, with the package's folder on its Python workers' path."""
    spark = df.sparkSession
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, only a session on one machine gets a temporary folder,
    removed when the process ends; on a cluster that is an error, since executors
    would write where others cannot read.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='lathe-')}"
        spark.conf.set("spark.checkpoint.dir", path)
        atexit.register(shutil.rmtree, path.removeprefix("file://"), ignore_errors=True)
    return path


def staged(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet and read it back: lineage ends here, and no executor holds the only copy.

    Columns of it can be read alone. The folder stays; whoever owns the shared folder clears it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lathe-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
