"""Spark session defaults and the shared checkpoint folder.

Every operator in the package is a plain ``DataFrame -> DataFrame`` function
and works on any session. ``get_spark`` only bundles the settings the jobs are
designed around:

* AQE on, with partition coalescing and skew-join splitting, so hot senders or
  merchants are split at runtime and small join sides are broadcast only after
  their real (measured) size is known (static size estimates never broadcast).
* dynamic partition overwrite, so rewriting one ``_date`` leaves the others.
* UTC session clock, so ``to_date`` / ``hour`` / ``unix_timestamp`` do not
  depend on the machine.
* UI off: no web server is started.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Tuning values for the cluster target (about 128 MB per scan split, shuffle
# partitions sized by AQE from an upper bound).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: the static planner's estimates after
    # filters and aggregates can be far off at scale, so it never broadcasts;
    # AQE converts a join to broadcast once the real shuffle output of a side
    # is known to be under the threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # HMAC key pads are binary literals of token plans: hide them in explain output
    "spark.sql.redaction.string.regex": r"0x[0-9A-Fa-f]{32,}",
    # checkpoint files of frames that are no longer referenced are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Initial shuffle width on a cluster. AQE merges small shuffle partitions up to
# the advisory size but does not split evenly large ones, so the start must be
# wide enough for the biggest shuffle: the dedup of ~30 TB of Bronze rows over
# 32768 partitions is ~1 GB per task before AQE coalescing of smaller stages.
CLUSTER_SHUFFLE_PARTITIONS = 32768


def get_spark(
    master: str | None = None,
    app_name: str = "txnlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_CONF)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # shuffle width is a runtime setting: decide it from the actual master
    if shuffle_partitions is None and not spark.sparkContext.master.startswith("local"):
        shuffle_partitions = CLUSTER_SHUFFLE_PARTITIONS
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is given by the deployment (a shared file system
    every executor reaches) and is only read here. A fresh local folder is
    made only when the setting is absent *and* the master is local, as in
    tests; a cluster without the setting is an error, because lineage cuts
    must survive the loss of any executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        existing = sc.getCheckpointDir()
        if existing:
            return existing
        path = tempfile.mkdtemp(prefix="txnlake-ckpt-", dir=os.environ.get("TMPDIR"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, eager: bool = True):
    """Checkpoint ``df`` into the shared checkpoint folder (never a local one).

    Used where one computed frame feeds several branches of a plan: the
    branches then read the reliable checkpoint instead of recomputing (and
    re-shuffling) the whole upstream, and a lost executor does not force a
    recompute from the source.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
