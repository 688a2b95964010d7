"""Session construction (for tests / bench) and the shared scratch location.

Library operators never build a session; the caller owns it.  The helpers
here are used by tests, ``bench.py`` and operators that must materialise a
table (round trips, layouts, lineage cuts).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tablework", extra: dict | None = None,
                  checkpoint_if_unset: str | None = None) -> SparkSession:
    """A session tuned for local runs; on a cluster pass the cluster's master
    and a shuffle-partition count sized to ~128-256 MB per partition.

    ``checkpoint_if_unset`` is registered as the checkpoint folder only when
    the session's configuration names none (local tests and bench)."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if checkpoint_if_unset and not sc.getCheckpointDir() \
            and not sc.getConf().get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(checkpoint_if_unset)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Where neither is set, a local master (one machine) gets
    a folder under the SQL warehouse location; on a cluster, whose executors
    do not share a local folder, this raises.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        wh = spark.conf.get("spark.sql.warehouse.dir")
        d = wh.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for a written table under the shared
    checkpoint root (each call gets its own folder; nothing is reused)."""
    return f"{checkpoint_root(spark).rstrip('/')}/tablework/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per
    application (``addPyFile``), for sessions whose workers do not have it on
    their path.  The zip is made on the driver, which serves it itself."""
    sc = spark.sparkContext
    if _SHIPPED.get("to") == sc.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "tablework.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("tablework", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED["to"] = sc.applicationId


_SHIPPED: dict = {}
