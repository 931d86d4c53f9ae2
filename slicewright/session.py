"""Session helpers.

Library code never builds its own session: it takes the caller's.  These
helpers are for tests, the bench and command-line runs on one machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "slicewright",
                  memory: str = "8g", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set, a session on one machine (tests, a laptop) takes a
    folder in its warehouse; on a cluster the warehouse may be a folder of one
    machine, so the shared folder must be named.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("no folder that all executors share: set spark.checkpoint.dir")
        context.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "slicewright", *parts, uuid.uuid4().hex])


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, as ``--py-files`` would, once per application."""
    context = spark.sparkContext
    if getattr(context, "_slicewright_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="slicewright-"), "slicewright.zip")  # the driver serves it from there
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(d, name), os.path.relpath(os.path.join(d, name), os.path.dirname(home)))
    context.addPyFile(path)
    context._slicewright_shipped = True


__all__ = ["checkpoint_dir", "local_session", "scratch_path", "ship_package"]
