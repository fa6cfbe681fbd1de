"""Session settings and the shared work folder.

Nothing here creates data; it only pins the settings the operators rely on
(UTC session time zone, AQE) and resolves the shared folder used for
written intermediate tables and stream checkpoints.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the library needs for reproducible results. They are runtime SQL
# settings, so applying them to an existing session is cheap.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def builder(master: str | None = None, app: str = "strata", shuffle_partitions: int | None = None):
    """Session builder with the library's settings (used by tests and bench)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Pin runtime settings on a session created elsewhere (e.g. by a driver)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared filesystem or
    object store). Only when it is unset in local mode -- tests -- a folder is
    made here and registered on the session so that later calls agree.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    root = checkpoint_root(spark)
    leaf = "/".join(p.strip("/") for p in parts if p)
    path = f"{root}/strata/{leaf}" if leaf else f"{root}/strata"
    if unique:
        path = f"{path}-{uuid.uuid4().hex[:12]}"
    return path


def materialize(df):
    """Evaluate ``df`` once into the shared checkpoint folder and cut its lineage.

    Used where one expensive input feeds two branches of a plan (Spark would
    otherwise compute it twice) and before writes that replace a table. A
    reliable checkpoint survives executor loss; ``localCheckpoint`` would not.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_observed(df, **aggregates):
    """``materialize`` and a dict of aggregates of the rows, taken while they
    are written, not in a second pass."""
    seen = Observation()
    done = materialize(df.observe(seen, *[a.alias(name) for name, a in aggregates.items()]))
    got = seen.get
    return done, {name: got.get(name) for name in aggregates}


def materialize_with_mark(df, ts_col: str):
    """``materialize`` and the greatest ``ts_col`` (None without rows)."""
    done, got = materialize_observed(df, mark=F.max(F.col(ts_col)))
    return done, got["mark"]
