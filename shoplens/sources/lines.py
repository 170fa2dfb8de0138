"""Text-line sources (S1-S3), event time (S11) and view registration.

One line is one event.  A location is a folder of text files, or a Kafka topic
when ``servers`` is given; the same call serves batch and streaming.  Both kinds can be
read from an offset; see ``linelog.py`` for those of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.sources.linelog import LineLog


def kafka_options(servers: str, topics: list[str], start: str = "latest",
                  streaming: bool = True, **extra: str) -> dict[str, str]:
    """Options of the Kafka source.

    A batch read ends at the newest record and so cannot start at ``latest``; it has to say where it starts.
    """
    if not streaming and start == "latest":
        raise ValueError("a batch read needs a start: earliest, or offsets by topic and partition")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
    }
    options.update(extra)
    return options


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def lines(spark: SparkSession, location: str | list[str], streaming: bool = False,
          servers: str | None = None, start: str = "latest", **options: str) -> DataFrame:
    """Lines of one topic as ``value STRING``; of a list, the first topic is read."""
    first = location if isinstance(location, str) else location[0]
    reader = _reader(spark, streaming)
    if servers is not None:
        source = reader.format("kafka").options(
            **kafka_options(servers, [first], start, streaming, **options))
        return source.load().select(F.col("value").cast("string").alias("value"))
    return reader.format("text").options(**options).load(first).select("value")


def lines_from(spark: SparkSession, folder: str, start: str = "earliest", streaming: bool = False,
               **options: str) -> DataFrame:
    """Lines of a folder of text files as ``value STRING``, from ``earliest``, ``latest`` (streams) or offsets by file (JSON)."""
    spark.dataSource.register(LineLog)
    reader = _reader(spark, streaming).format("linelog").option("startingOffsets", start)
    return reader.options(**options).load(folder).select("value")


def multi_lines(spark: SparkSession, topics: dict[str, str] | list[str], streaming: bool = False,
                servers: str | None = None, start: str = "latest",
                **options: str) -> dict[str, DataFrame]:
    """One line stream per topic name: ``{name: folder}``, or topic names with ``servers``."""
    if servers is not None:
        return {name: lines(spark, name, streaming, servers, start, **options) for name in topics}
    return {name: lines(spark, folder, streaming, **options) for name, folder in topics.items()}


def with_event_time(df: DataFrame, delay: str = "200 milliseconds",
                    seconds: str = "timestamp", name: str = "ts") -> DataFrame:
    """Add the event-time column and its watermark.  The watermark acts on streams only."""
    return df.withColumn(name, F.timestamp_seconds(seconds)).withWatermark(name, delay)


def register(df: DataFrame, view: str) -> DataFrame:
    """Make a batch or streaming DataFrame visible to ``spark.sql``."""
    df.createOrReplaceTempView(view)
    return df
