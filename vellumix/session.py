"""Session settings the engine relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that change results or plan quality; cluster sizing is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(master: str | None = None, app: str = "vellumix", **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in conf.items()})
    spark = (b.master(master) if master else b).getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends the library to the Python workers, wherever the driver found it; once a Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_vellumix_sent", False):
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="vellumix-lib-")) / "vellumix.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(archive))
    sc._vellumix_sent = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    A local one is made only where none is set and driver and executors are one machine; on a cluster that is an error,
    as executors would write where the driver can't read.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="vellumix-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    The session's cleaner removes its files once nothing refers to it (``cleanCheckpoints`` in ``SETTINGS``).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)
