"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` adds to or overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Open windows live outside the executor heap, so state may outgrow it.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # A commit then writes what has changed; whole snapshots follow in the background.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for ``name`` below the folder set as ``spark.checkpoint.dir``.

    Every executor must see the folder, so a cluster, ``local-cluster`` included, has to name
    one. A single local process, which has no other executors, may leave it out: its
    intermediate tables then go below the warehouse folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
