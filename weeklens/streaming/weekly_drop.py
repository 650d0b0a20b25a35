"""Structured Streaming intake of weekly transaction drops (U2 as a stream).

New transactions arrive as parquet files in a drop folder. An intake is one
pass over what is new there: the stream folds each micro-batch into weekly
purchase cells and writes them below ``cells/intake=<k>``; when it has ended,
the cells of the intake are merged (a cell is positive if any batch says so),
gridded, and merged into the recent history (latest N weeks, new rows win) as
a new version of the state table, of which only the intake's weeks are written. The result depends on the drop alone, not on
how its rows are laid out in files or dealt to micro-batches.

Versions and batches are folders: a replayed batch after a failure rewrites
the same folder, and no job reads and overwrites one path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.operators.grid import KEYS, LABEL, build_grid, weekly_purchases
from weeklens.operators.incremental import merge_weeks
from weeklens.session import reliable_checkpoint
from weeklens.sources.versions import Versions

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("purchase_date", T.TimestampType()),
])


STATE = "state"


def latest_state(spark: SparkSession, state_dir: str) -> DataFrame | None:
    """The newest version of the state table, or None."""
    return Versions(spark, state_dir).read(STATE)


def _children(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the sub-folders ``<prefix><number>`` of ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def start_weekly_intake(spark: SparkSession, drop_dir: str, state_dir: str, checkpoint: str, intake: int,
                        files_per_batch: int = 1000, available_now: bool = True):
    """Start the stream of one intake; returns the ``StreamingQuery``. Each
    micro-batch of at most ``files_per_batch`` files (the batch size bounds
    memory, not the result) becomes purchase cells."""
    def fold(batch: DataFrame, epoch_id: int):
        weekly_purchases(batch).write.mode("overwrite").parquet(
            f"{state_dir}/cells/intake={intake}/batch={epoch_id}")

    stream = (spark.readStream.schema(TRANSACTION_SCHEMA)
              .option("maxFilesPerTrigger", files_per_batch).parquet(drop_dir))
    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def publish_intake(spark: SparkSession, customers: DataFrame, products: DataFrame, state_dir: str,
                   intake: int, weeks_to_include: int = 4) -> DataFrame | None:
    """Merge the cells of an ended intake into the state; returns the new state.
    Without new cells the state stays as it is. Only the weeks of the intake are
    written; the folded batches are removed once the version that names them is
    committed, under the intake's number, so that a replay does not merge twice."""
    cells_dir = f"{state_dir}/cells/intake={intake}"
    if not _children(spark, cells_dir, "batch="):
        return latest_state(spark, state_dir)
    cells = (spark.read.parquet(cells_dir).groupBy(*KEYS).agg(F.max(LABEL).alias(LABEL)))
    cells = reliable_checkpoint(cells)
    if cells.isEmpty():
        return latest_state(spark, state_dir)
    new = build_grid(None, customers, products, cells=cells)
    merge_weeks(Versions(spark, state_dir), STATE, new, weeks_to_include, tag=f"intake={intake}")
    _remove(spark, cells_dir)
    return latest_state(spark, state_dir)


def run_weekly_intake(spark: SparkSession, drop_dir: str, customers: DataFrame, products: DataFrame,
                      state_dir: str, checkpoint: str, weeks_to_include: int = 4,
                      files_per_batch: int = 1000) -> DataFrame | None:
    """One intake from start to end: everything new in the drop folder is
    folded and merged. After a failure, calling it again goes on where it
    stopped: the intake number changes only when its version is written."""
    done = Versions(spark, state_dir).tagged("intake=")
    pending = []
    for k in _children(spark, f"{state_dir}/cells", "intake="):
        if k in done:  # its version was written, only the clean-up is left
            _remove(spark, f"{state_dir}/cells/intake={k}")
        else:
            pending.append(k)
    intake = pending[-1] if pending else (done[-1] + 1 if done else 0)
    start_weekly_intake(spark, drop_dir, state_dir, checkpoint, intake, files_per_batch).awaitTermination()
    return publish_intake(spark, customers, products, state_dir, intake, weeks_to_include)
