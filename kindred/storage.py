"""Written intermediates: cut lineage on storage every executor can reach."""

import tempfile
import threading
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import Observation

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Spark removes the shuffle files of a query at its end; without it they stay until the driver collects its garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths staged by this driver, by application.
_STAGED = {}
# Where a table read back by `materialize` lies.
_PATHS = weakref.WeakKeyDictionary()
# How many blocks of `shuffles_removed` are open, by application, and the setting before the first of them.
_OPEN, _LOCK = {}, threading.Lock()


def checkpoint_root(spark):
    """Shared folder named by the cluster; a temporary one only where none is set and the master is local.

    On a cluster a folder of one machine would lose rows, so none is made up there.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share; the master is {master}")
        root = tempfile.mkdtemp(prefix="kindred-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark, label):
    """A fresh path below the checkpoint folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_staged(spark):
    """Delete everything staged so far; frames that read it can no longer be used. Returns how many paths went."""
    return sum(_delete(spark, path) for path in _STAGED.pop(spark.sparkContext.applicationId, []))


def _delete(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(table):
    """Delete a table that `materialize` wrote and that only written tables were made from."""
    spark, path = table.sparkSession, _PATHS.pop(table)
    _STAGED[spark.sparkContext.applicationId].remove(path)
    _delete(spark, path)


@contextmanager
def shuffles_removed(spark):
    """Queries started inside leave no shuffle files behind.

    For jobs whose plan is run once: a write, or a few measured numbers.
    """
    application = spark.sparkContext.applicationId
    with _LOCK:
        depth, before = _OPEN.get(application, (0, None))
        if not depth:
            before = spark.conf.get(CLEANUP_KEY, "false")
            spark.conf.set(CLEANUP_KEY, "true")
        _OPEN[application] = depth + 1, before
    try:
        yield
    finally:
        with _LOCK:
            depth, before = _OPEN.pop(application)
            if depth > 1:
                _OPEN[application] = depth - 1, before
            else:
                spark.conf.set(CLEANUP_KEY, before)


def first_row(df):
    """The first row of a small aggregate, of whose plan no shuffle files stay."""
    with shuffles_removed(df.sparkSession):
        return df.first()


def materialize(df, label):
    """Write `df` as Parquet in the shared folder and return the table read back.

    Used where a costly frame feeds several branches, so building such a plan runs jobs.
    The copy survives the loss of executors, prunes columns for each reader, and gives the
    optimizer its true size. It stays until `release_staged`; the shuffle files behind it
    go as soon as it is written.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def settled(spark, make, label):
    """The table that `make` gives, written; whatever it staged for that is deleted."""
    staged = _STAGED.setdefault(spark.sparkContext.applicationId, [])
    before = set(staged)
    table = materialize(make(), label)
    for path in [p for p in staged if p not in before and p != _PATHS[table]]:
        staged.remove(path)
        _delete(spark, path)
    return table


def materialize_observed(df, label, **metrics):
    """`materialize`, plus a dict of aggregates taken while the rows are written."""
    watch = Observation()
    table = materialize(df.observe(watch, *[column.alias(name) for name, column in metrics.items()]), label)
    return table, watch.get
