"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more rows than one of so many parts of a table, and than so many rows, is dealt to several tasks.
SHARES, SHARE_ROWS = 1000, 10_000


_OWN: dict[str, str] = {}
#: The folder of the scratch tables in the making; each thread has its own.
_SCOPE: ContextVar[str | None] = ContextVar("spanloom_scope", default=None)
#: Drops a job's shuffle files when it has ended: a stored table needs them no more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, as a URI.

    A path without a scheme is on the cluster's default file system. Where the
    setting is unset, a local master (tests) gets a folder of its own; a cluster
    has none that all its machines see, so there the job stops.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder for intermediate tables")
    if not at:
        app = spark.sparkContext.applicationId
        at = _OWN.setdefault(app, "") or "file://" + tempfile.mkdtemp(prefix="spanloom-")
        _OWN[app] = at
    if "://" not in at:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        at = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/(?!/)", "file:///", at).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{_SCOPE.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts lineage, so a lost executor costs a reread and not a recomputation.
    """
    return _written(df, scratch_path(df.sparkSession, name), compression)


def _written(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df._scratch)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def finished(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, stored; the tables that were stored on the way are deleted."""
    path = scratch_path(spark, name)
    inner = f"{path}-parts"
    before = _SCOPE.set(inner)
    try:
        return _written(make(), path)
    finally:
        _SCOPE.reset(before)
        _delete(spark, inner)


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: str, how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """Join on keys of which a few may hold much of ``left``.

    A key with more than one of ``SHARES`` parts of the rows is heavy; there are
    fewer than ``SHARES`` of these. A heavy key's rows are dealt by ``spread`` to
    as many tasks as they fill parts, and its rows of ``right`` are repeated for
    each. Other keys are joined as they are. ``left`` is read twice, unless
    ``counts`` (the keys and ``_n``) is given: store it, if it isn't cheap. Null
    keys match nothing.
    """
    total = left.count() if counts is None else counts.agg(F.sum("_n")).first()[0] or 0
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if counts is None else counts
    if total <= SHARE_ROWS:
        return left.join(right, keys, how)
    share = max(SHARE_ROWS, total / SHARES)
    heavy = counts.filter(F.col("_n") > share).select(*keys, F.ceil(F.col("_n") / share).cast("int").alias("_salts"))
    rows = heavy.collect()  # fewer than SHARES
    if not rows:
        return left.join(right, keys, how)
    heavy = F.broadcast(left.sparkSession.createDataFrame(rows, heavy.schema))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = left.join(heavy, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("_salts")
    copies = right.join(heavy, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt")
