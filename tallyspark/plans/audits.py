"""The audits run together: what each unresolved row is, where its player may be found, and the outputs people read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import valued
from ..operators import audit
from ..session import materialise
from ..sources.landing import write_csv

_KEYS = ("league", "season", "game_id", "team_id", "team_name", "source_player_id", "player_name", "player_id", "row_id")


def _rows(stats: DataFrame) -> DataFrame:
    """The columns of a statistics table that the audits read; texts that are no value are null."""
    return stats.select(*[(valued(c) if c in ("team_id", "team_name", "source_player_id", "player_name", "player_id") else F.col(c)).alias(c) for c in _KEYS if c in stats.columns])


def described(audited: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Candidate rows with the candidate's team by name: audited rows, candidate_team_name added, null where the team is unknown."""
    known = teams.select(F.col("league").alias("_l"), F.col("season").cast("string").alias("_s"), F.col("team_id").alias("_t"), F.col("team_name").alias("candidate_team_name")).groupBy("_l", "_s", "_t").agg(F.min("candidate_team_name").alias("candidate_team_name"))
    on = (F.col("league") == F.col("_l")) & (F.col("candidate_season") == F.col("_s")) & (F.col("candidate_team") == F.col("_t"))
    return audited.join(known, on, "left").drop("_l", "_s", "_t")


def run_audits(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The nine outputs by name, from the canonical tables; what none is unresolved in gives empty frames.

    A candidate of a team's roster is named within the row, since a team's
    roster bounds them; those of other teams and seasons come out as rows.
    """
    games, seasons, teams = (_rows(tables[t]) for t in ("player_game_stats", "player_season_stats", "team_season_stats"))
    unresolved = {"player_game_stats": games.where("player_id is null"), "player_season_stats": seasons.where("player_id is null"), "team_season_stats": teams.where("team_id is null")}
    rosters, players = tables["rosters"], tables["players"]

    def order(df: DataFrame) -> list[str]:
        return [c for c in ("team_id", "game_id", "player_name", "row_id") if c in df.columns]

    of_games = materialise(audit.numbered(audit.audit_players(unresolved["player_game_stats"], rosters, players, games.where("player_id is not null")), order(games)))
    of_seasons = materialise(audit.numbered(audit.audit_players(unresolved["player_season_stats"], rosters, players), order(seasons)))
    of_teams = materialise(audit.numbered(audit.audit_teams(unresolved["team_season_stats"], tables["teams"]), order(teams)))
    audits = {"player_game_stats": of_games, "player_season_stats": of_seasons, "team_season_stats": of_teams}
    named = [described(audit.candidate_rows(df, rosters, players), players, tables["teams"]).withColumn("dataset", F.lit(name)) for name, df in list(audits.items())[:2]]
    queue = materialise(audit.disposition_queue(audits))
    by_class = reduce(DataFrame.unionByName, [audit.summary(df, ["evidence_class"]).withColumn("dataset", F.lit(name)) for name, df in list(audits.items())[:2]])
    by_diagnosis = reduce(DataFrame.unionByName, [audit.summary(df, ["diagnosis"]).withColumn("dataset", F.lit(name)) for name, df in audits.items()])
    return {
        "player_game_audit": of_games,
        "player_season_audit": of_seasons,
        "team_season_audit": of_teams,
        "candidate_evidence": reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named),
        "source_id_evidence": audit.source_id_frequency(unresolved["player_game_stats"]) if "source_player_id" in games.columns else tables["players"].limit(0),
        "diagnosis_summary": by_diagnosis.orderBy("dataset", F.desc("count"), "diagnosis"),
        "evidence_summary": by_class.orderBy("dataset", F.desc("count"), "evidence_class"),
        "disposition_queue": queue,
        "disposition_summary": audit.summary(queue, ["dataset", "disposition"]),
    }


def write_audits(outputs: dict[str, DataFrame], folder: str) -> list[str]:
    """Each output as a CSV folder below ``folder``, summaries in one file; the names of those that have rows."""
    return [name for name, df in outputs.items() if write_csv(df, f"{folder}/{name}", single=name.endswith("summary"), skip_empty=True)]
