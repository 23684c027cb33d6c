"""Session settings and the shared folder that materialised tables live in."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# A lookup side is broadcast only when its counted rows stay below this. Keys and
# rates are a few dozen bytes each, so the hash relation stays under ~100 MB.
BROADCAST_ROWS = 500_000
# Keys are text of any length: what they take together is counted too.
BROADCAST_BYTES = 50_000_000

#: Open files of one task that writes by folder. Up to here it need not sort its rows by folder first; beyond, Spark sorts as before.
_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.maxConcurrentOutputFileWriters": "32"}

_local_folders: dict[str, str] = {}
_shipped: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the wide row-local projections and the writes by year need.

    HotSpot never compiles a method above 8000 bytes of bytecode. Past that size a
    fused stage runs interpreted, several times slower than unfused operators, so
    fusion is given up exactly there. A write by folder otherwise sorts, and spills,
    every wide row of a task only to close one file before the next is opened.
    """
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def tuned(spark: SparkSession):
    """``tune`` for the work inside; the caller's own settings are put back."""
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    tune(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def apart(spark: SparkSession) -> SparkSession:
    """A session of its own with the same settings. One that has observed metrics can no longer ship fitted
    models that refer to it, so observing is done apart from the caller's."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def local_session(cpus: int | str = "*", app: str = "tarmac") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    partitions = "8" if cpus == "*" else str(cpus)
    return tune(
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, for clusters where it is not installed on them.

    Spark serves the archive from the driver for as long as the application runs; once per application.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _shipped or not package.is_dir():  # an archive was shipped already
        return
    archive = Path(tempfile.mkdtemp(prefix="tarmac-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for module in sorted(package.rglob("*.py")):
            packed.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tarmac-")
    return _local_folders[context.applicationId]


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives executor loss, and gives later plans true file sizes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tarmac-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
