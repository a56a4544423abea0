"""Recovery of invalid responses: repaired documents, the report, the reconciliation with what was invalid."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import preview
from ..operators.relational import reconcile
from ..operators.repair import RECOVERABLE, classify_response, reason_level, recover_texts, recoverable
from ..session import materialise, ship
from ..sources import files
from ..sources.landing import read_invalid, write_csv

REPORT = ("source_file", "recovered_file", "league", "season", "endpoint", "resource_id", "category", "success", "recovery_rule", "parse_error", "source_size_bytes", "output_size_bytes")

# What to do about each reason.
ACTIONS = {
    "VALID_JSON_MARKED_INVALID": "parse again", "PYTHON_LITERAL": "read as a literal", "MALFORMED_GAME_DATA": "repair", "MALFORMED_STANDINGS_DATA": "repair", "MALFORMED_JSON": "repair",
    "EMPTY": "none", "NO_DATA": "none", "EMPTY_PLAYER_STATS": "none", "HTML_RESPONSE": "fetch again", "API_ERROR": "fetch again", "TEXT_RESPONSE": "review", "UNKNOWN": "review",
}


def audit_invalid(invalid: DataFrame) -> DataFrame:
    """(league, season, endpoint, resource_id, reason, recoverable, recommended_action, file, size_bytes, preview) of each invalid response."""
    classed = invalid.withColumn("reason", classify_response(F.col("text"), F.col("endpoint")))
    action = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])[F.col("reason")]
    return classed.select("league", "season", "endpoint", "resource_id", "reason", recoverable(F.col("reason")).alias("recoverable"), action.alias("recommended_action"), F.col("relative").alias("file"), "size_bytes", preview("text").alias("preview"))


def recover_invalid(invalid: DataFrame, root: str) -> DataFrame:
    """Repairs the responses and writes what succeeds below root/recovered; the report, one row each.

    Every written document is read back before it counts as a success.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                path, size = None, None
                if r["success"]:
                    path = "recovered/" + r["relative"].removesuffix(".invalid.txt") + ".json"
                    files.write_text(r["recovered"], f"{root}/{path}")
                    if files.read_text(f"{root}/{path}") != r["recovered"]:
                        r |= {"success": False, "parse_error": "what was written reads back otherwise"}
                    size = files.size(f"{root}/{path}")
                rows.append({"source_file": "raw/" + r["relative"], "recovered_file": path, "output_size_bytes": size, "source_size_bytes": r["size_bytes"], **{k: r[k] for k in REPORT if k in r and k not in ("source_file", "recovered_file", "source_size_bytes", "output_size_bytes")}})
            kinds = {"season": pa.int64(), "success": pa.bool_(), "source_size_bytes": pa.int64(), "output_size_bytes": pa.int64()}
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(c, kinds.get(c, pa.string())) for c in REPORT]))

    ship(invalid.sparkSession)
    repaired = recover_texts(invalid.select("relative", "text", "league", "season", "endpoint", "resource_id", "size_bytes"), "text", "endpoint").drop("text")
    kinds = {"season": "long", "success": "boolean", "source_size_bytes": "long", "output_size_bytes": "long"}
    # written once: a report that is read twice must not write the documents twice
    return materialise(repaired.mapInArrow(run, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in REPORT)))


def recover_all(spark: SparkSession, root: str) -> DataFrame:
    return recover_invalid(read_invalid(spark, root), root)


def write_report(report: DataFrame, path: str) -> None:
    """As CSV by RFC 4180: quotes doubled, nulls empty, booleans in lower case."""
    write_csv(report.select(*REPORT), path)


def rule_histogram(report: DataFrame) -> DataFrame:
    """(category, recovery_rule, count) of what succeeded, the most frequent first; a rule is the steps that led to it."""
    return report.where("success").groupBy("category", "recovery_rule").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "category", "recovery_rule")


def first_failures(report: DataFrame, n: int = 20) -> DataFrame:
    """(source_file, category, parse_error) of the first ``n`` tried and failed, by path: a report for people, which the limit is part of."""
    return report.where("not success").orderBy("source_file").limit(n).select("source_file", "category", "parse_error")


def reconciliation(invalid_audit: DataFrame, report: DataFrame) -> DataFrame:
    """Per category: raw, attempted, recovered, failed, unattempted and outstanding responses; differences are never negative."""
    n = F.count("*").alias("n")
    counts = {
        "raw": invalid_audit.where(F.col("reason").isin(*RECOVERABLE)).groupBy(F.col("reason").alias("category")).agg(n),
        "attempted": report.where("category is not null").groupBy("category").agg(n),
        "recovered": report.where("success").groupBy("category").agg(n),
    }

    def less(a: str, b: str):
        return F.greatest(F.col(a) - F.col(b), F.lit(0).cast("long"))

    both = reconcile(counts, "category")
    return both.withColumns({"failed": less("attempted", "recovered"), "unattempted": less("raw", "attempted"), "outstanding": less("raw", "recovered")})


def recovery_findings(invalid_audit: DataFrame, report: DataFrame) -> DataFrame:
    """Findings about invalid responses: recovered ones for information, outstanding ones as warnings, the rest by their reason."""
    by = reconciliation(invalid_audit, report)
    finding = ["level", "table_name", "check_name", "message", "count"]

    def told(df: DataFrame, level, check: str, what: str, count: str) -> DataFrame:
        return df.where(F.col(count) > 0).select(level.alias("level"), F.lit("raw").alias("table_name"), F.lit(check).alias("check_name"), F.col(what).alias("message"), F.col(count).cast("long").alias("count")).select(*finding)

    others = invalid_audit.where("not recoverable").groupBy("reason").agg(F.count("*").alias("n"))
    return told(by, F.lit("INFO"), "recovered", "category", "recovered").unionByName(told(by, F.lit("WARNING"), "outstanding", "category", "outstanding")).unionByName(told(others, reason_level(F.col("reason")), "invalid_response", "reason", "n"))
