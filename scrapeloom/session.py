"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_FOLDERS: dict[str, str] = {}  # per application, local masters only


def build_session(app: str = "scrapeloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI and adaptive execution; ``conf`` entries win.

    Skewed joins are split at run time. ``forceOptimizeSkewedJoin`` accepts one
    more shuffle for that, because one company may own a third of all rows.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own. Nothing in the
    folder is needed once the application has ended.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="scrapeloom-")
    return _LOCAL_FOLDERS[context.applicationId]


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on upstream tasks, so a lost executor repeats
    nothing, and the planner knows its true size, so that joins with it are
    broadcast only when it is really small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
