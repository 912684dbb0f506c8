"""Session helpers: a tuned local session for tests and benches, and the
reliable checkpoint folder taken from the session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on; set on sessions built by ``local_session``.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "winnow",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A ``local[cores]`` session for tests and benches."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a ``local[...]``
    session without one (tests, benches), where driver and tasks are one
    process, gets a temporary folder; elsewhere a missing setting is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    own = getattr(sc, "_winnow_shared", None)
    if own is None:
        own = sc._winnow_shared = tempfile.mkdtemp(prefix="winnow-shared-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``shared_dir`` that goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path)
    fs.deleteOnExit(jvm_path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set below ``shared_dir`` if unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(spark))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


PACKAGE = os.path.dirname(os.path.abspath(__file__))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers. Workers started in the
    repository or with it on PYTHONPATH have it; else a zip of the package goes
    to the shared folder and from there to every worker."""
    root = os.path.dirname(PACKAGE)
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root in {os.path.realpath(p) for p in known if p} or getattr(spark, "_winnow_shipped", False):
        return
    shared = shared_dir(spark).removeprefix("file://")
    if "://" in shared:  # not a mounted folder: submit the package with --py-files
        return
    local = f"{shared}/winnow-{uuid.uuid4().hex}.zip"
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with zipfile.ZipFile(local, "w") as z:
        for folder, _, names in os.walk(PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    spark.sparkContext.addPyFile(local)
    spark._winnow_shipped = True
