"""Folders for intermediate tables: in the cluster's shared folder, removed when the driver ends."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name below spark.checkpoint.dir; in a local session without one, below a temporary folder."""
    sc = spark.sparkContext
    top = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="quadrille-")
    path = f"{top.rstrip('/')}/quadrille/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    from .sources import files

    try:
        files.remove(spark, path)
    except Exception:  # the JVM has gone: nothing is left to do
        pass
