"""Session helpers: the shared work folder and conservative defaults.

Library code never changes global configuration of a session it did not
create. The only folder it writes intermediate data to is the cluster's
checkpoint directory (``spark.checkpoint.dir``), which is a shared,
fault-tolerant location on a real cluster.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Let the JIT compile large generated methods (recommended for executors too).
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the context's checkpoint folder, or ``spark.checkpoint.dir``.

    Where neither is set, a local session gets a folder beside its warehouse
    (``spark.sql.warehouse.dir``). On a cluster nothing is known that every executor reaches and that
    survives the loss of one, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        conf = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_tripflow_scratch")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint directory for one staged write."""
    return os.path.join(checkpoint_dir(spark), f"tripflow-{name}-{uuid.uuid4().hex}")


def session_with(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """A session of its own with the caller's settings and ``conf``; the caller's is left as it is."""
    own = spark.newSession()
    for k, v in (spark.conf.getAll | conf).items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def local_session(app: str = "tripflow", cores: int | str = "*", shuffle_partitions: int = 8,
                  checkpoint: str | None = None, extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on).

    ``checkpoint`` is only applied where the session has no checkpoint folder yet.
    """
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", "8g")
         # PySpark call-site capture costs ~1 ms per Column call while building plans
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         # wide staging projections generate methods above the JVM's 8 KB JIT limit
         .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
         .config("spark.executor.extraJavaOptions", JIT_OPTIONS))
    if checkpoint:
        b = b.config(CHECKPOINT_CONF, checkpoint)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if checkpoint and not (sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_CONF, None)):
        sc.setCheckpointDir(checkpoint)
    return spark
