"""Readers of table directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ship
from . import files


class MissingTables(FileNotFoundError):
    """Tables that a step can't do without."""


# The canonical tables, the files a step may ask for.
TABLES = ("teams", "players", "rosters", "games", "player_game_stats", "player_season_stats", "team_season_stats", "standings")


def load_tables(spark: SparkSession, root: str, names: tuple[str, ...] = TABLES, required: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """The tables of a folder, Parquet before CSV; raises once with all of ``required`` (all of ``names`` without it) that are neither.

    A CSV has a header; its columns are texts, cast by the rules and models that read them.
    """
    ship(spark)
    found = {}
    for name in names:
        for suffix, read in ((".parquet", spark.read.parquet), (".csv", spark.read.option("header", True).option("quote", '"').option("escape", '"').csv)):
            if files.exists(f"{root}/{name}{suffix}"):
                found[name] = read(f"{root}/{name}{suffix}")
                break
    lacking = [n for n in (names if required is None else required) if n not in found]
    if lacking:
        raise MissingTables(f"no Parquet or CSV of {', '.join(lacking)} in {root}")
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of a data directory; Catalyst prunes columns and pushes filters."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")
