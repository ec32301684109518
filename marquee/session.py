"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings a job should start with; everything else stays at Spark's defaults.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Materialised steps are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


LOCAL_FOLDER = "file:///tmp/checkpoints"


def session(app: str = "marquee", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors reach; a local session without one gets :data:`LOCAL_FOLDER`."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = LOCAL_FOLDER
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and read it back.

    Needed where a value depends on the physical row order (numbering) and must come out the same
    when the plan is read twice or an executor is lost. See :func:`shared_folder`.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that a job wrote for itself."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
