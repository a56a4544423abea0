"""Streams of landed files: responses classified and report lines parsed as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.broken_lines import load_report_lines
from ..operators.repair import classify_response, recoverable
from ..sources.landing import path_parts


def stream_invalid(spark: SparkSession, raw: str, files_per_trigger: int = 1_000) -> DataFrame:
    """Invalid responses below ``raw`` (…/raw) as they land, classified; every file once, whatever the restarts."""
    files = (
        spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.invalid.txt")
        .option("maxFilesPerTrigger", files_per_trigger).load(raw).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("landed_at"), F.col("value").alias("text"))
    )
    named = files.select("file", "landed_at", "text", *[c.alias(n) for n, c in path_parts(F.col("file"), "raw").items()])
    classed = named.withColumn("reason", classify_response(F.col("text"), F.col("endpoint")))
    return classed.select("landed_at", "league", "season", "endpoint", "resource_id", "reason", recoverable(F.col("reason")).alias("recoverable"), "relative")


def stream_report_lines(lines: DataFrame) -> DataFrame:
    """Records of recovery reports from a stream of (line_id, report_file, line_text): typed, or with the reason they are broken."""
    return load_report_lines(lines)


def reasons_by_window(classified: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Responses per reason and window of arrival; windows close when files ``late`` can't come any more."""
    return classified.withWatermark("landed_at", late).groupBy(F.window("landed_at", width).alias("w"), "league", "reason").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "league", "reason", "n")


def start(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream to Parquet until what is there has been read; the checkpoint makes it exactly once."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
