"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.models import Models
from ..sources.tables import table
from . import encoding, matching, packing, spellings, stuffing, survivors
from .sql import SQL

__all__ = ["QUERIES", "SQL"]


def p5_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.game_line_survivors(table(spark, sf_dir, "player_game_stats"), table(spark, sf_dir, "feed_trust"))


def p5_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that the lines of a group agree on token by token, whatever their feeds."""
    voted = survivors.game_line_survivors(table(spark, sf_dir, "player_game_stats"), table(spark, sf_dir, "feed_trust"), by_rank=False)
    return voted.select("group_row_id", "field_name", "value", "source_row_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_survivors(spark, sf_dir).select("group_row_id", "field_name", "source_row_id")


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per group, built field by field."""
    fields = [F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f) for f in survivors.GAME_FIELDS]
    return p5_survivors(spark, sf_dir).groupBy("league", "season", "game_id", "team_id", "player_id", "group_row_id").agg(*fields)


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.link_spellings(table(spark, sf_dir, "players"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.pairs_of_classes(p6_classes(spark, sf_dir))


def p6_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of every person in players, game lines and roster memberships, and whether it is one of the person's name."""
    members = Models.of(spark, sf_dir).int_roster_memberships().select("player_id", F.col("canonical_player_name").alias("player_name"))
    typed = {"players": table(spark, sf_dir, "players"), "lines": table(spark, sf_dir, "player_game_stats"), "rosters": members}
    return spellings.spellings_of_persons(p6_classes(spark, sf_dir), {name: df.select("player_id", "player_name") for name, df in typed.items()})


def _matches(spark: SparkSession, sf_dir: str) -> matching.SourceMatches:
    return matching.SourceMatches(*(table(spark, sf_dir, t) for t in ("player_game_stats", "rosters", "players")))


def p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir).best()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_matches(spark, sf_dir).select("player_id", "source_player_id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_texts(table(spark, sf_dir, "documents"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = encoding.count_tokens(table(spark, sf_dir, "documents"))
    return packing.pack(sizes, table(spark, sf_dir, "pack_sizes"))


def p9_waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_waste(p9_containers(spark, sf_dir))


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffing.stuffed_pages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "spam_labels"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p5_found": p5_found,
    "p5_records": p5_records,
    "p5_consensus": p5_consensus,
    "p6_found": p6_found,
    "p6_classes": p6_classes,
    "p6_spellings": p6_spellings,
    "p7_found": p7_found,
    "p7_matches": p7_matches,
    "p8_ids": p8_ids,
    "p9_containers": p9_containers,
    "p9_waste": p9_waste,
    "p10_found": p10_found,
    "p10_scores": p10_scores,
}
