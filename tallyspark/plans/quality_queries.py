"""The registered queries of the quality rules, and their SQL, which states the rules on its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from ..sources.tables import table
from .model_queries import SQL as MODEL_SQL
from .models import Models

TABLES = ("teams", "players", "rosters", "games", "player_game_stats", "player_season_stats", "team_season_stats", "standings")


def quality_findings(spark: SparkSession, d: str) -> DataFrame:
    """All rules over all eight tables; duplicates and missing parents of the tables as they were loaded."""
    return quality.in_order(quality.check_all({t: table(spark, d, t) for t in TABLES}, TABLES))


def rank_order_levels(spark: SparkSession, d: str) -> DataFrame:
    """How many findings there are of each level."""
    return quality_findings(spark, d).groupBy("level").count().withColumnRenamed("count", "n_findings")


def mart_tests(spark: SparkSession, d: str) -> DataFrame:
    models = Models.of(spark, d)
    return quality.check_marts({name: models.core(name) for name in Models.CORE})


def accepted_values(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_table("orders", table(spark, d, "orders"), quality.Rules(accepted={"o_orderstatus": ("F", "O")}), required=[])


def _found(level: str, name: str, check: str, message: str, count: str, source: str = "", where: str = "true") -> str:
    return f"select '{level}' as level, '{name}' as table_name, '{check}' as check_name, {message} as message, cast({count} as bigint) as count from {source or name} where {where} having {count} > 0"


def _nulls(name: str, *columns: str) -> list[str]:
    return [_found("ERROR", name, "not_null", f"'{c}'", "count(*)", where=f"{c} is null") for c in columns]


def _negative(name: str, columns: str) -> list[str]:
    return [_found("WARNING", name, "non_negative", f"'{c}'", "count(*)", where=f"{c} < 0") for c in columns.split()]


def _repeated(name: str, keys: str, level: str, where: str = "true") -> str:
    return _found(level, name, "unique", f"'{keys}'", "count(*)", f"(select 1 from {name} where {where} group by {keys} having count(*) > 1)")


def _missing(child: str, parent: str, keys: str, given: bool) -> str:
    """Different keys of the child that no row of the parent has; ``given``: keys with a null don't count."""
    columns = keys.split(", ")
    same = " and ".join(f"p.{c} = c.{c}" for c in columns)
    where = " and ".join(f"{c} is not null" for c in columns) if given else "true"
    keyed = f"(select distinct {keys} from {child} c where {where} and not exists (select 1 from {parent} p where {same}))"
    return _found("ERROR", child, "foreign_key", f"'{keys} -> {parent}'", "count(*)", keyed)


_GAME = "passing_attempts passing_completions passing_interceptions rushing_carries receiving_catches receiving_tds tackles tackle_assists tackles_combined sacks interceptions fg_made fg_attempts"
_SEASON = """tackles_for_loss forced_fumbles fumble_recoveries passes_deflected blocked_kicks kickoff_returns kickoff_return_tds punt_returns punt_return_tds
interception_return_tds fumble_recovery_tds pat_made pat_attempts punts total_points tds two_point_conversions safety"""
_SCOPE = "league, season, team_id"

_FINDINGS = " union all ".join([
    _repeated("teams", _SCOPE, "ERROR"), *_nulls("teams", "league", "season", "team_id", "team_name"),
    _repeated("players", "player_id", "ERROR"), *_nulls("players", "player_id", "player_name"),
    _repeated("rosters", f"{_SCOPE}, player_id", "ERROR"), *_nulls("rosters", "league", "season", "team_id", "player_id"),
    _missing("rosters", "teams", _SCOPE, False), _missing("rosters", "players", "player_id", False),
    _repeated("games", "league, season, game_id", "ERROR"), *_nulls("games", "league", "season", "game_id", "home_team_name", "visitor_team_name"),
    *_negative("games", "visitor_score home_score"),
    _found("ERROR", "games", "rows", "'home_is_visitor'", "count(*)", where="home_team_name = visitor_team_name"),
    _found("INFO", "games", "rows", "'missing_scores'", "(count(*) - count(home_score) + count(*) - count(visitor_score))"),
    _repeated("player_game_stats", f"league, season, game_id, team_id, player_id", "WARNING", "player_id is not null"),
    _repeated("player_game_stats", f"league, season, game_id, team_id, source_player_id", "WARNING", "player_id is null and source_player_id is not null"),
    *_negative("player_game_stats", _GAME),
    _found("WARNING", "player_game_stats", "rows", "'unresolved_player'", "count(*)", where="player_id is null"),
    _found("WARNING", "player_game_stats", "share", "format('unresolved_player: {:.2f} % of the rows', 100.0 * (count(*) - count(player_id)) / count(*))", "(count(*) - count(player_id))"),
    _missing("player_game_stats", "teams", _SCOPE, False), _missing("player_game_stats", "games", "league, season, game_id", False), _missing("player_game_stats", "players", "player_id", True),
    _repeated("player_season_stats", f"{_SCOPE}, player_id", "WARNING", "team_id is not null and player_id is not null"), *_negative("player_season_stats", f"{_GAME} {_SEASON}"),
    _found("WARNING", "player_season_stats", "range", "'completion_pct'", "count(*)", where="completion_pct < 0 or completion_pct > 100"),
    _found("WARNING", "player_season_stats", "rows", "'unresolved_player'", "count(*)", where="player_id is null"),
    _found("WARNING", "player_season_stats", "rows", "'unresolved_team'", "count(*)", where="team_id is null"),
    _missing("player_season_stats", "teams", _SCOPE, True), _missing("player_season_stats", "players", "player_id", True),
    _repeated("team_season_stats", _SCOPE, "WARNING", "team_id is not null"), *_negative("team_season_stats", "total_points"),
    _found("WARNING", "team_season_stats", "rows", "'unresolved_team'", "count(*)", where="team_id is null"), _missing("team_season_stats", "teams", _SCOPE, True),
    _found("ERROR", "standings", "range", "'win_pct'", "count(*)", where="win_pct < 0 or win_pct > 1"), *_negative("standings", "wins losses ties points_for points_against win_pct"),
    "select 'INFO', 'standings', 'coverage', 'league: no wnfc', cast(1 as bigint) from standings having count(*) filter (league = 'wnfc') = 0",
])


def _mart(name: str, columns: str) -> list[str]:
    source = f"({MODEL_SQL[name]})"
    tests = [_found("ERROR", name, "not_null", f"'{c}'", "count(*)", source, f"{c} is null") for c in columns.split()]
    return [*tests, _found("ERROR", name, "accepted_values", "'league'", "count(*)", source, "league not in ('wfa', 'wnfc')")]


_MARTS = " union all ".join([
    *_mart("mart_players", "league season team_id team_name player_id"), *_mart("mart_player_game_logs", "league season game_id team_id"), *_mart("mart_player_season_stats", "league season"),
    *_mart("mart_qb_season_stats", "league season passing_attempts"), *_mart("mart_player_career_stats", "league player_id"), *_mart("mart_team_season_summary", "league season"),
])

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "quality_findings": quality_findings,
    "rank_order_levels": rank_order_levels,
    "mart_tests": mart_tests,
    "accepted_values": accepted_values,
}
SQL: dict[str, str] = {
    "quality_findings": _FINDINGS,
    "rank_order_levels": f"select level, count(*) as n_findings from ({_FINDINGS}) group by level",
    "mart_tests": _MARTS,
    "accepted_values": _found("ERROR", "orders", "accepted_values", "'o_orderstatus'", "count(*)", where="o_orderstatus not in ('F', 'O')"),
}
