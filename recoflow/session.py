"""Session helpers.

Every job in this package assumes the session time zone is UTC (epoch
seconds are the canonical time and ``as_of`` midnights must not move with
the host). ``prepare`` pins that on a session handed to us; ``local_session``
builds the session used by tests and the bench.
"""

from __future__ import annotations

import importlib
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone every job relies on; the rest is the cluster's (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "recoflow") -> SparkSession:
    """Session for tests and the local bench (single JVM)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RECOFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return prepare(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is; without it a cluster run is an error.  A local master
    (tests) gets a scratch folder.  The folder is set once: each call of
    ``setCheckpointDir`` would append another level to the path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver context; the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="recoflow-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage: write ``df`` once to the shared checkpoint folder.

    Used where a job reads the same derived input several times (the
    recommendation job reads the interactions six ways).  Re-reading a
    materialised copy is cheaper than recomputing the chain each time, and
    a lost executor re-reads files instead of re-running upstream stages.
    Never a machine-local cache: the folder is ``spark.checkpoint.dir``.
    """
    if not ensure_checkpoint_dir(df.sparkSession):
        return df  # no shared folder configured: keep the lineage
    return df.checkpoint(eager=True)


def ship(spark: SparkSession, *modules: str) -> SparkSession:
    """Make the package importable in Python workers (data sources, stateful
    streams). Submitted with ``--py-files`` it is there already. The workers that
    plan a stream on the driver do not see added files: what they need from ``modules``
    travels with the pickled objects instead."""
    for name in modules:
        cloudpickle.register_pickle_by_value(importlib.import_module(name))
    sc = spark.sparkContext
    if getattr(sc, "_recoflow_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    if ".zip" not in str(root):
        target = Path(tempfile.mkdtemp(prefix="recoflow-ship-")) / "recoflow.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, Path("recoflow") / file.relative_to(root))
        sc.addPyFile(str(target))
    sc._recoflow_shipped = True
    return spark
