"""A decision log as a stream: the latest decision of each item, kept as a table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.decisions import latest


def read_log(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    """An append-only folder of Parquet log files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


#: Batches after which the changes are folded into a whole state.
BATCHES_A_STATE = 20


def keep_latest(log: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], batches_a_state: int = BATCHES_A_STATE):
    """Starts a query that keeps the latest row of each key below ``path``.

    A batch writes the latest of its own rows, so its cost is its own size; now
    and then the changes are folded with the state before them, and what that
    state replaces is deleted, but for the state before, which a reader may
    hold. Rows are folded by ``order``, so a late record never replaces a newer
    decision, and a batch that runs again writes the same. Read it with
    ``read_latest``.
    """
    fold = _folding(path, keys, order, batches_a_state, lambda batch: latest(batch, keys, order))
    return log.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_counted(log: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], batches_a_state: int = BATCHES_A_STATE):
    """As ``keep_latest``, with ``decisions``, the number of records that each key has had so far.

    The state store holds a key's latest row and its count, which a task merges
    with partial aggregates, so a busy key costs no more than others; a batch
    writes the keys that it touched. A late record is counted and replaces
    nothing. Read it with ``read_latest`` and ``[*order, "decisions"]``.
    """
    rest = [c for c in log.columns if c not in keys]
    state = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"), F.count(F.lit(1)).alias("decisions")).select(*keys, "r.*", "decisions")
    fold = _folding(path, keys, [*order, "decisions"], batches_a_state, lambda batch: batch)
    return state.writeStream.outputMode("update").foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _folding(path: str, keys: list[str], order: list[str], batches_a_state: int, changes: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Writes a batch's changes, and a whole state now and then."""

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        changes(batch).write.mode("overwrite").parquet(f"{path}/batch={number:012d}")
        if (number + 1) % batches_a_state:
            return
        states = [n for n in _numbers(spark, path, "state") if n < number]
        whole = _folded(spark, path, keys, order, number)
        whole.write.mode("overwrite").parquet(f"{path}/state={number:012d}")
        if states:
            for kind, last in (("batch", states[-1]), ("state", states[-1] - 1)):
                for n in _numbers(spark, path, kind):
                    if n <= last:
                        _delete(spark, f"{path}/{kind}={n:012d}")

    return fold


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The numbers of whole folders of a kind, in order."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = [s.getPath() for s in fs.listStatus(hadoop)]
    done = [p for p in names if p.getName().startswith(f"{kind}=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def _folded(spark: SparkSession, path: str, keys: list[str], order: list[str], upto: int) -> DataFrame | None:
    states = [n for n in _numbers(spark, path, "state") if n < upto]
    last = states[-1] if states else -1
    parts = [f"{path}/state={n:012d}" for n in states[-1:]] + [f"{path}/batch={n:012d}" for n in _numbers(spark, path, "batch") if last < n <= upto]
    return latest(reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in parts]), keys, order) if parts else None


def read_latest(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame | None:
    """The latest row of each key after the last whole batch; None before the first."""
    return _folded(spark, path, keys, order, 1 << 62)
