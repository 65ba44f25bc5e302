"""Session helpers: local session for tests, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the engine expects (UTC, AQE)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("talkloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _own_folder(master: str) -> str:
    """A folder for a local session that names none; it is removed when Python ends. A cluster must name a shared one."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="talkloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a reliable checkpoint; it runs at once.

    The folder is ``spark.checkpoint.dir`` of the session, which all executors share. Only in a local session
    where neither that nor a checkpoint directory is set, as in tests, a temporary one is made.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or _own_folder(sc.master))
    return df.checkpoint()
