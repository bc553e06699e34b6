"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. Hour arithmetic is done on wall-clock time, so the zone is pinned;
# AQE sizes shuffle partitions from real bytes and splits hot join partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT = "spark.sql.files.maxPartitionBytes"
SOURCE_SHARE = 4 << 20  # bytes of Parquet per shuffle partition that AQE starts from


def fit_to(spark: SparkSession, path: str) -> None:
    """Let the parts that tasks work on depend on the size of the source at ``path``, not on a fixed number of partitions.

    AQE only merges shuffle partitions, so with a fixed number the rows that one task reads and sorts grow with the table. It starts from one for each
    ``SOURCE_SHARE`` bytes instead, if that is more than the session's own number, which is never lowered. Scans are split finely enough for the sort or
    hash table in front of a shuffle, unless the session sets its own size.
    """
    files, place = _file_system(spark, path)
    wanted = files.getContentSummary(place).getLength() // SOURCE_SHARE + 1
    if wanted > max(int(spark.conf.get(INITIAL, "1")), int(spark.conf.get("spark.sql.shuffle.partitions"))):
        spark.conf.set(INITIAL, str(wanted))
    if spark.conf.get(SPLIT, None) is None:
        spark.conf.set(SPLIT, "32m")


def session(app: str = "lakestrata", master: str | None = None, **conf: str) -> SparkSession:
    """A new session with the runtime settings; extra settings as keyword arguments with '__' for '.'."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with the machine, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="lakestrata-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the work folder that nothing has used before."""
    return f"{work_dir(spark)}/lakestrata/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the work folder and return the written table.

    Cuts lineage so that a lost executor costs a re-read, not a re-run, fixes the rows that later
    steps number or compare, and gives the planner real file sizes for its broadcast decision.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, what ``materialize`` wrote inside: for steps whose result is a stored table."""
    before = len(_written)
    try:
        yield
    finally:
        for path in _written[before:]:
            delete_path(spark, path)
        del _written[before:]


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    files, place = _file_system(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(place) if entry.isDirectory())


def new_beside(path: str) -> str:
    """A folder name next to ``path`` that nothing has used before, on the same file system."""
    return f"{path.rstrip('/')}__new-{uuid.uuid4().hex[:12]}"


def swap_path(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts the folder ``fresh`` in the place of ``path`` by renaming; the old folder goes last."""
    files, place = _file_system(spark, path)
    new = _file_system(spark, fresh)[1]
    old = None
    files.mkdirs(place.getParent())
    if files.exists(place):
        old = _file_system(spark, f"{path.rstrip('/')}__old-{uuid.uuid4().hex[:12]}")[1]
        if not files.rename(place, old):
            raise OSError(f"cannot move {path} aside")
    if not files.rename(new, place):
        if old is not None:
            files.rename(old, place)
        raise OSError(f"cannot move {fresh} to {path}")
    if old is not None:
        files.delete(old, True)
