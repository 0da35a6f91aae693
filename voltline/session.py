"""Session helpers: a tuned local session for tests/bench, and the shared scratch folder.

On a cluster the session is owned by the caller; we only read ``spark.checkpoint.dir`` from
it. Only when that setting is absent (local tests) do we point it at a fresh temp folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "voltline") -> SparkSession:
    """Session used by tests and bench: AQE on, UI off, zone pinned (report times are zone-free)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set a temp one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.split("[")[0] == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="voltline-ckpt-"))
    else:  # executors would each write to their own disk
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir().rstrip("/")


#: Scratch folders that this process has named, in order.
_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint root (never a machine-local path on a cluster)."""
    path = f"{checkpoint_root(spark)}/voltline-scratch/{purpose}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_made() -> list[str]:
    """The scratch folders named so far and not dropped: a job takes the list before it begins, to drop what it added."""
    return list(_SCRATCH)


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders that no frame in use reads any more."""
    for path in paths:
        if path in _SCRATCH:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
            _SCRATCH.remove(path)


def open_filesystem(path: str):
    """(pyarrow filesystem, path inside it), for the writers that run in tasks: a local path or any URI pyarrow knows."""
    from pyarrow import fs as pafs

    if path.startswith("file:"):
        local = "/" + path[len("file:"):].lstrip("/")
        return pafs.LocalFileSystem(), local.rstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path.rstrip("/"))
    return pafs.LocalFileSystem(), path.rstrip("/")


def materialize(df, purpose: str = "stage", with_count: bool = False):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    One job (a reliable ``checkpoint()`` runs its input twice unless it is cached), the lineage is cut
    (a lost executor later re-reads files instead of re-running the plan), and later readers get
    column pruning and row-group statistics. ``with_count`` also returns the row count, observed on
    the write itself (no extra job).
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    obs = Observation(purpose)
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return (out, obs.get["n"]) if with_count else out


def drop_frame(df) -> None:
    """Delete what ``materialize`` wrote for ``df``: neither it nor a frame made of it may be read any more."""
    path = getattr(df, "scratch_path", None)
    if path:
        drop_scratch(df.sparkSession, [path])


def path_exists(path: str, spark: SparkSession | None = None) -> bool:
    """True when a file or folder exists at ``path``, in any file system that the session's Hadoop knows."""
    spark = spark or SparkSession.getActiveSession()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def glob_escaped(path: str) -> str:
    """A path that the reader takes as it stands, whatever glob characters its names hold."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``voltline`` importable in Python workers (as ``--py-files`` would), once per application.

    Needed by the operators that run Python on executors (zip expansion, file writers); the zip is
    built on the driver and distributed by Spark.
    """
    import os
    import zipfile

    import voltline

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(voltline.__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="voltline-pyfiles-"), "voltline.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
