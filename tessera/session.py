"""Spark session helpers.

Cluster rule: lineage is cut with ``DataFrame.checkpoint()`` into the shared
folder named by ``spark.checkpoint.dir``.  We read that setting from the
session and only invent a folder when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera") -> SparkSession:
    """Session with AQE, UTC and Arrow on, UI off."""
    master = master or os.environ.get("TESSERA_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("TESSERA_SHUFFLE_PARTITIONS", "8"))
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in the Python workers (once per context).

    Arrow functions defined in this package are pickled by reference, so
    executors must be able to import it.  The package's .py files are zipped
    on the driver and distributed with ``SparkContext.addPyFile`` (as
    ``--py-files`` would on a cluster).
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import tessera
    root = os.path.dirname(os.path.dirname(os.path.abspath(tessera.__file__)))
    zpath = os.path.join(tempfile.mkdtemp(prefix="tessera-pkg-"), "tessera.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(os.path.join(root, "tessera")):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a scratch one only where none is set and Spark runs in
    one process.  On a cluster a folder of one machine would lose the data: that raises."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: Bytes of an Arrow batch where whole texts or sets are sent to Python.
BATCH_BYTES = 8 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches end after ``BATCH_BYTES`` in what is computed meanwhile, so that 10,000 long
    rows are not held at once on both sides (the session's setting comes back)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def swap(old: DataFrame | None, new: DataFrame, checkpoint: bool = False) -> DataFrame:
    """Advance a loop's state: persist (or reliably checkpoint) ``new``,
    materialise it, then release ``old`` so cached rounds never pile up."""
    from pyspark import StorageLevel
    if checkpoint:
        nxt = cut_lineage(new)
    else:
        nxt = new.persist(StorageLevel.MEMORY_AND_DISK)
        nxt.count()
    if old is not None:
        old.unpersist()
    return nxt


def materialize(df: DataFrame) -> DataFrame:
    """Persist (memory+disk) and fill the cache now.

    A lazily persisted table read by several branches of one query is
    computed once per branch: AQE submits those stages together, before
    the cache exists.  Filling it first makes expensive stages (Python
    tokenising, MinHash) run once.  Lost blocks are recomputed from lineage.
    """
    from pyspark import StorageLevel
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def materialize_sets(df: DataFrame) -> DataFrame:
    """:func:`materialize` for tables of whole texts or sets, in small batches."""
    with small_batches(df.sparkSession):
        return materialize(df)
