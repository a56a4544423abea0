"""Landed files: raw and recovered documents, invalid responses, CSV tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import valued
from ..operators.broken_lines import ENDPOINTS, TYPED
from ..operators.relational import keep_first


def path_parts(path: Column, root: str) -> dict[str, Column]:
    """league, season, endpoint and resource_id from a path under ``root``; unknown endpoints are null, a season that is no number is null."""
    rel = F.regexp_extract(path, rf"(?:^|/){root}/(.*)$", 1)
    parts = F.split(rel, "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"(\.invalid)?\.(json|txt)$", "")
    deep = F.size(parts) > 3
    # players/<id>/info.json: the folder is the id, the file the endpoint
    endpoint = F.when(deep & (F.get(parts, F.lit(2)) == "players") & (F.size(parts) > 4), stem).when(deep, F.get(parts, F.lit(2))).otherwise(stem)
    return {
        "relative": rel,
        "league": F.get(parts, F.lit(0)),
        "season": F.get(parts, F.lit(1)).try_cast("bigint"),
        "endpoint": F.when(endpoint.isin(*ENDPOINTS, "info"), endpoint),
        "resource_id": F.when(deep & (F.size(parts) > 4), F.get(parts, F.lit(3))).when(deep, stem),
    }


def read_texts(spark: SparkSession, root: str, folder: str, pattern: str) -> DataFrame:
    """Whole files under root/folder as (file, text, relative, league, season, endpoint, resource_id)."""
    try:
        files = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(f"{root}/{folder}").select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
        files.schema
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        files = spark.createDataFrame([], "file string, text string")
    return files.select("file", "text", *[c.alias(n) for n, c in path_parts(F.col("file"), folder).items()])


def read_overlay(spark: SparkSession, root: str) -> DataFrame:
    """The documents of raw and recovered; of one relative path the raw one wins. Files outside league/season folders are left out."""
    both = read_texts(spark, root, "raw", "*.json").withColumn("layer", F.lit(0)).unionByName(read_texts(spark, root, "recovered", "*.json").withColumn("layer", F.lit(1)))
    first = keep_first(both.select("relative", "layer", "file"), ["relative"], ["layer"]).select("file", "layer")
    return both.join(first, ["file", "layer"], "left_semi").where("season is not null").drop("layer")


def read_invalid(spark: SparkSession, root: str) -> DataFrame:
    """Responses that failed to parse when they were fetched, with their size and place."""
    return read_texts(spark, root, "raw", "*.invalid.txt").withColumn("size_bytes", F.octet_length("text").cast("long"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV with a header under a stated schema; null tokens and values that don't fit their type are null."""
    want = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in want])
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).schema(texts).csv(path)
    return raw.select(*[valued(f.name).try_cast(f.dataType).alias(f.name) for f in want])


def load_recovery_report(spark: SparkSession, path: str) -> DataFrame:
    """The recovery report typed; an empty typed frame where the file or one of its columns is missing. true, 1 and yes are success."""
    names = [c.strip().split()[0] for c in TYPED.split(",")]
    try:
        head = spark.read.option("header", True).csv(path).columns
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        head = []
    if not set(names) <= set(head):
        return spark.createDataFrame([], TYPED)
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    kinds = dict((c.strip().split()[0], c.strip().split()[1]) for c in TYPED.split(","))
    return raw.select(*[F.lower(F.col(c)).isin("true", "1", "yes").alias(c) if c == "success" else valued(c).try_cast("bigint" if kinds[c] == "long" else kinds[c]).alias(c) for c in names])


def write_csv(df: DataFrame, path: str, single: bool = True, skip_empty: bool = False) -> bool:
    """A CSV folder with a header, by RFC 4180: quotes doubled, nulls empty, booleans in lower case; whether it was written.

    ``single``: one file, for reports of people's size; tables of any size are
    written as they are partitioned. ``skip_empty`` writes nothing of a frame without rows.
    """
    if skip_empty and df.isEmpty():
        return False
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    (texts.coalesce(1) if single else texts).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)
    return True
