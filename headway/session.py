"""Session helpers: UTC clock, ANSI SQL, AQE, and a shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on (UTC hour features, ANSI errors surfaced,
# adaptive re-planning for skew and partition coalescing).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows of whole documents go to Python workers: few at a time bound the
    # Arrow buffers of both sides
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "headway", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster use spark-submit and :func:`configure`."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers: its sources go to the
    executors once per application, through Spark's own file distribution."""
    sc = spark.sparkContext
    if getattr(sc, "_headway_shipped", False):
        return
    root = Path(__file__).resolve().parent
    zipped = Path(tempfile.mkdtemp(prefix="headway-src-")) / "headway_src.zip"
    with zipfile.ZipFile(zipped, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(zipped))
    sc._headway_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it and it is only read here; unset, that
    is an error, because executors could not see a folder of the driver's.
    Only a ``local`` master (tests) gets a fresh temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="headway-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def keep(df: DataFrame) -> DataFrame:
    """Persists a table that one plan reads several times, spilling to disk;
    :func:`release` frees it once the plan's result is written."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.setdefault(df.sparkSession.sparkContext.applicationId, []).append(df)
    return df


def release(spark: SparkSession) -> int:
    """Frees what :func:`keep` has persisted in this application; results that
    are not written yet are computed anew. Returns the number of tables."""
    kept = _KEPT.pop(spark.sparkContext.applicationId, [])
    for df in kept:
        df.unpersist()
    return len(kept)


_KEPT: dict[str, list[DataFrame]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder (not yet made) of the shared folder, for a written table."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
