"""Tables between steps: written to the folder that driver and executors share, read again, and removed in the end."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Scopes that are open, the innermost last: folders whose tables go when the scope ends.
_scopes: list[str] = []
#: Temporary folders of local sessions that name none, by application.
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where the session names none and runs in one process (tests), a temporary folder is made and kept for the session.
    On a cluster this is an error: a folder of the driver's machine would be another one on every executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        # A running session does not let this setting be changed.
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="tallymart-")
        folder = _own[app]
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str, outside: bool = False) -> str:
    """A path in the shared folder that nothing uses yet, inside the innermost scope (outside: inside the one around it, if there is one)."""
    scopes = _scopes[:-1] if outside else _scopes
    return f"{scopes[-1] if scopes else shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go when the block ends: for callers that have written what they need by then."""
    folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield
    finally:
        _scopes.remove(folder)
        remove(spark, folder)


#: Rows that a task writes at least, where the number of rows is known.
ROWS_A_FILE = 50_000


def written(df: DataFrame, label: str, rows: int | None = None, outside: bool = False, codec: str = "snappy") -> DataFrame:
    """df written as a Parquet table in the shared folder and read again.

    rows: how many there are at most, if that is known: a small table is then dealt to few tasks before it is written, not cut into as many
    files as a shuffle has partitions. The stage that makes the rows keeps its tasks. outside: it stays when the innermost scope ends.

    This cuts the lineage: a lost executor later costs a read of the table, not the work before it,
    and values such as spark_partition_id() or monotonically_increasing_id() stay what they were.
    """
    spark = df.sparkSession
    path = new_path(spark, label, outside)
    (df if rows is None else df.repartition(max(6, -(-rows // ROWS_A_FILE)))).write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage: shuffle files of finished jobs stay on the executors' disks until it does.

    Twice, as what the first round lets go of may be the last to hold a shuffle.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def known_to_workers(spark: SparkSession) -> SparkSession:
    """The session, with this package's folder on its Python workers' path.

    For workers on this machine that were started from another folder; on a cluster the package is shipped (--py-files).
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), root) if x)
    return spark


def unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, from name."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
