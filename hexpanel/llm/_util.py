"""Shared-folder tables for cutting lineage."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_MADE: list[tuple[int, str, str, SparkSession]] = []  # thread, what, path, session of every table that is still there


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where that is unset, a folder of our own on a local
    master; on a cluster, where no such folder is shared, a RuntimeError."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    key = context.applicationId
    if key not in _OWN:
        _OWN[key] = "file://" + tempfile.mkdtemp(prefix="hexpanel-")
    return _OWN[key]


def new_path(spark: SparkSession, what: str) -> str:
    """A path for a table; what is written there is removed when Python ends, if not before."""
    path = f"{shared_dir(spark)}/hexpanel-{what}-{uuid.uuid4().hex}"
    _MADE.append((threading.get_ident(), what, path, spark))
    return path


def cut(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read back: later jobs don't recompute it, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def mark() -> int:
    return len(_MADE)


def clear(since: int, keep: tuple[str, ...] = ()) -> None:
    """Removes what this thread has written since a mark, but for the tables called as in keep."""
    mine = [x for x in _MADE[since:] if x[0] == threading.get_ident() and x[1] not in keep]
    for x in mine:
        _MADE.remove(x)
        _remove(x[3], x[2])


def tidy(*keep: str) -> Callable:
    """Decorator: what a function writes is removed when it returns or fails, but for the tables called as in keep,
    which its lazy result still reads."""

    def wrap(f: Callable) -> Callable:
        @wraps(f)
        def run(*args, **kwargs):
            since = mark()
            try:
                out = f(*args, **kwargs)
            except BaseException:
                clear(since)
                raise
            clear(since, keep)
            return out

        return run

    return wrap


@atexit.register
def _remove_all() -> None:
    for _, _, path, spark in _MADE:
        try:
            _remove(spark, path)
        except Exception:  # the session's JVM may be gone
            return


def fresh(df: DataFrame, *names: str) -> list[str]:
    """names, each with underscores in front until no column of df (in either case) has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the C library that has it
        pass


def slim(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """Decorator for what a Python worker maps over a partition: at its end the worker gives back to the system what its
    allocators keep, since it waits for the next task beside the executor's JVM with all that it once took."""

    @wraps(run)
    def over(it: Iterator) -> Iterator:
        try:
            yield from run(it)
        finally:
            _trim()

    return over
