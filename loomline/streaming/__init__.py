"""The batch operators as Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from loomline.functions.text import normalise_title
from loomline.functions.url import url_key


def windowed_counts(stream: DataFrame, time: str, by: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """``start, by, n`` per tumbling window; records later than ``late`` are dropped by the watermark."""
    grouped = stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), by)
    return grouped.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def sessions(stream: DataFrame, time: str, by: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n")


def distinct_articles(stream: DataFrame, time: str, late: str = "2 days") -> DataFrame:
    """The first of each address and normalised title within the watermark; state is bounded by it."""
    keyed = stream.withColumn("_k", F.coalesce(F.nullif(url_key("url"), F.lit("")), normalise_title("title")))
    return keyed.withWatermark(time, late).dropDuplicatesWithinWatermark(["_k"]).drop("_k")


def each_batch(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs a batch transform on every micro-batch; ``once`` takes what is there and stops. ``write`` gets the batch number and should replace what that number wrote."""
    out = stream.writeStream.foreachBatch(lambda df, n: write(transform(df), n)).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def follow_parquet(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
