"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "clientlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with AQE on and UTC time.

    ``master`` and ``shuffle_partitions`` are only set when given: on a cluster
    they come from spark-submit. Size ``spark.sql.shuffle.partitions`` so one
    partition is ~100-200 MB of shuffle data at the target scale; AQE then
    coalesces small ones and splits skewed join partitions.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # remove reliable checkpoint files once their DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster: the SparkContext's
    folder, set from ``spark.checkpoint.dir`` if nobody has set it yet.

    Raises when neither is set. A machine-local folder would lose its blocks
    with the machine, so none is made up here; tests set one of their own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()
