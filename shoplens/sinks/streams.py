"""Stream sinks: console, append files, exactly-once daily documents, upsert (K1-K5).

Every file sink names what a micro-batch writes by its batch id, once, so a restart
from the checkpoint leaves one copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shoplens.operators import hot


def console_sink(stream: DataFrame, label: str, mode: str = "append") -> StreamingQuery:
    """K1: print a stream under a label."""
    return stream.writeStream.queryName(label).format("console").outputMode(mode).option("truncate", False).start()


def memory_sink(stream: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """K1 for tests: small results only, they end up in the driver."""
    return stream.writeStream.queryName(name).format("memory").outputMode(mode).start()


def _start(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None],
           mode: str, drain: bool) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def _complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` has ended; Spark leaves the marker when it commits the job."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def batches(spark: SparkSession, path: str, name: str = "batch_id") -> list[int]:
    """The micro-batches below ``path`` whose write has ended, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    numbers = sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{name}="))
    return [n for n in numbers if _complete(spark, f"{path}/{name}={n}")]


def published(spark: SparkSession, path: str, schema: str | StructType, fmt: str = "parquet", after: int = -1) -> DataFrame:
    """What a sink has written, whole micro-batches only, with ``batch_id``.

    A folder is read once its write has ended and left its marker, so a reader beside a running
    stream, or after a crash, never sees half a micro-batch.
    """
    found = [f"{path}/batch_id={n}" for n in batches(spark, path) if n > after]
    if not found:
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0))
    return spark.read.format(fmt).schema(schema).option("basePath", path).load(found)


def write_batch(df: DataFrame, batch_id: int, path: str, partitions: tuple[str, ...] = (),
                max_records: int = 0, fmt: str = "parquet") -> None:
    """Write one micro-batch into its own ``batch_id`` folder.

    A batch that is run again after its folder was completed is left as it is, so readers
    never see it go; one that broke off before is written over.
    """
    if _complete(df.sparkSession, f"{path}/batch_id={batch_id}"):
        df.write.format("noop").mode("overwrite").save()  # the state of the batch has to be committed again
        return
    if partitions:
        # few files per target folder, while a folder that gets most rows is still split
        df = df.hint("rebalance", *partitions)
    (
        df.write.mode("overwrite").format(fmt).option("maxRecordsPerFile", max_records)
        .partitionBy(*partitions).save(f"{path}/batch_id={batch_id}")
    )


def append_sink(stream: DataFrame, path: str, checkpoint: str, drain: bool = False,
                transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """K5, append-only: closed rows to files; ``transform`` may use batch-only operators."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(transform(df) if transform else df, batch_id, path)
    return _start(stream, checkpoint, write, "append", drain)


def split_sink(stream: DataFrame, paths: dict[str, str], checkpoint: str, column: str,
               drain: bool = False) -> StreamingQuery:
    """Main and side outputs of one stream: the rows with each value of ``column`` to a path of their own."""
    def write(df: DataFrame, batch_id: int) -> None:
        held = df.persist()
        try:
            for value, path in paths.items():
                write_batch(held.where(F.col(column) == value).drop(column), batch_id, path)
        finally:
            held.unpersist()
    return _start(stream, checkpoint, write, "append", drain)


def daily_sink(documents: DataFrame, path: str, checkpoint: str, max_records: int = 100_000,
               fmt: str = "json", drain: bool = False) -> StreamingQuery:
    """K2-K4: documents below ``batch_id=.../day=...``, at most ``max_records`` per file."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df, batch_id, path, ("day",), max_records, fmt)
    return _start(documents, checkpoint, write, "append", drain)


def upsert_sink(stream: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """K5, update mode: every change is kept with its batch id; see :func:`latest`."""
    return _start(stream, checkpoint, lambda df, batch_id: write_batch(df, batch_id, path), "update", drain)


def latest(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of every key of an upsert sink."""
    rest = [c for c in versions.columns if c not in keys and c != "batch_id"]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
    return newest.select(*keys, "_row.*")


def compact(spark: SparkSession, path: str, base: str, keys: list[str], schema: str | StructType) -> int:
    """Folds what an upsert sink has written so far into one table below ``base``; the last micro-batch in it.

    ``base`` holds a table for each call, named by that micro-batch; readers take the newest.
    The sink goes on meanwhile, and its older folders may be removed afterwards.
    """
    done = batches(spark, path)
    if done and done[-1] not in batches(spark, base, "upto"):
        rows = current(spark, path, base, keys, schema)
        rows.write.mode("overwrite").parquet(f"{base}/upto={done[-1]}")
    return done[-1] if done else -1


def current(spark: SparkSession, path: str, base: str, keys: list[str], schema: str | StructType) -> DataFrame:
    """:func:`latest` of an upsert sink, from the newest compacted table and the micro-batches after it."""
    upto = batches(spark, base, "upto")
    newer = published(spark, path, schema, after=upto[-1] if upto else -1)
    if upto:
        older = spark.read.parquet(f"{base}/upto={upto[-1]}").withColumn("batch_id", F.lit(upto[-1]))
        newer = older.unionByName(newer)
    return latest(newer, keys)


def changes(versions: DataFrame, keys: list[str], skip_equal: bool = False) -> DataFrame:
    """The versions as a retract stream: ``added`` false takes a row back, true puts one in.

    ``skip_equal`` leaves out versions that repeat the one before.
    """
    rest = [c for c in versions.columns if c not in keys and c != "batch_id"]
    in_order = Window.partitionBy(*keys).orderBy("batch_id")
    row = F.struct(*rest)
    paired = versions.select(*keys, "batch_id", row.alias("_new"), F.lag(row).over(in_order).alias("_old"))
    if skip_equal:
        paired = paired.where(~F.col("_new").eqNullSafe(F.col("_old")))
    entry = lambda added, column: F.struct(F.lit(added).alias("added"), F.col(column).alias("row"))
    entries = F.array(entry(False, "_old"), entry(True, "_new"))
    return (
        paired.select(*keys, "batch_id", F.inline(F.filter(entries, lambda e: e["row"].isNotNull())))
        .select(*keys, "batch_id", "added", "row.*")
    )


def top_n_sink(counts: DataFrame, id_col: str, path: str, checkpoint: str, n: int = 5,
               drain: bool = False) -> StreamingQuery:
    """A2 on a stream: in append mode all counts of a window close in one micro-batch, which is ranked."""
    return append_sink(counts, path, checkpoint, drain, lambda df: hot.top_n(df, id_col, n))


def late_split_sink(marked: DataFrame, on_time: str, late: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """A6 on a stream: rows with ``late`` to ``on_time`` or ``late``."""
    side = marked.withColumn("_side", F.when(F.col("late"), "late").otherwise("on time")).drop("late")
    return split_sink(side, {"on time": on_time, "late": late}, checkpoint, "_side", drain)


def uv_from_sketches(sketches: DataFrame, per_window: bool = False) -> DataFrame:
    """Counts from the latest sketch of each window, cumulative by default."""
    if not per_window:
        so_far = Window.orderBy("window_end").rowsBetween(Window.unboundedPreceding, 0)
        sketches = sketches.withColumn("sketch", F.hll_union_agg("sketch").over(so_far))
    return sketches.select(F.lit("uv").alias("url"), "window_end", F.hll_sketch_estimate("sketch").alias("count"))
