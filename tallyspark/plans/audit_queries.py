"""The registered queries of the audits, and their SQL, which states the classes and their order on its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import valued
from ..operators import audit
from ..sources.tables import table

_STRIP = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160)"
_TOKENS = "'', '-', 'NULL', 'null', 'None', 'Not Reported', 'N/A', 'NR'"


def _value(c: str) -> str:
    return f"case when trim({c}, {_STRIP}) not in ({_TOKENS}) then trim({c}, {_STRIP}) end"


def _stripped(c: str) -> str:
    return f"case when trim({c}, {_STRIP}) <> '' then trim({c}, {_STRIP}) end"


def _norm(c: str) -> str:
    return f"nullif(trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]+', ' ', 'g')), '')"


def lines(spark: SparkSession, d: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows without a player, rows with one) of a statistics table, texts that are no value null."""
    df = table(spark, d, name)
    source = valued("source_player_id") if "source_player_id" in df.columns else F.lit(None).cast("string")
    rows = df.select("row_id", "league", "season", source.alias("source_player_id"), *[valued(c).alias(c) for c in ("team_id", "player_name", "player_id")])
    return rows.where("player_id is null"), rows.where("player_id is not null")


def _audited(spark: SparkSession, d: str, name: str) -> DataFrame:
    unresolved, resolved = lines(spark, d, name)
    return audit.audit_players(unresolved, table(spark, d, "rosters"), table(spark, d, "players"), resolved if name == "player_game_stats" else None)


def audit_player_games(spark: SparkSession, d: str) -> DataFrame:
    return _audited(spark, d, "player_game_stats").select("row_id", "diagnosis", "evidence_class", "disposition")


def audit_player_seasons(spark: SparkSession, d: str) -> DataFrame:
    """Seasons have no source ids, so that evidence is left out; rows are numbered within league and season."""
    return audit.numbered(_audited(spark, d, "player_season_stats"), ["row_id"]).select("row_id", "audit_row", "diagnosis", "evidence_class", "disposition")


def audit_team_seasons(spark: SparkSession, d: str) -> DataFrame:
    unresolved = table(spark, d, "team_season_stats").withColumn("team_id", valued("team_id")).where("team_id is null")
    return audit.audit_teams(unresolved, table(spark, d, "teams")).select("row_id", "diagnosis")


def audit_summary(spark: SparkSession, d: str) -> DataFrame:
    return audit.summary(audit_player_games(spark, d), ["disposition", "diagnosis"])


def audit_queue(spark: SparkSession, d: str) -> DataFrame:
    """The rows of all three audits with what becomes of them."""
    unresolved = table(spark, d, "team_season_stats").withColumn("team_id", valued("team_id")).where("team_id is null")
    audits = {
        "player_game_stats": _audited(spark, d, "player_game_stats"), "player_season_stats": _audited(spark, d, "player_season_stats"),
        "team_season_stats": audit.audit_teams(unresolved, table(spark, d, "teams")),
    }
    return audit.disposition_queue(audits).select("dataset", "row_id", "disposition")


def audit_source_ids(spark: SparkSession, d: str) -> DataFrame:
    return audit.source_id_frequency(lines(spark, d, "player_game_stats")[0])


def audit_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The one roster member that another team or season of the league has under a row's name."""
    found = audit.candidate_rows(_audited(spark, d, "player_game_stats"), table(spark, d, "rosters"), table(spark, d, "players"))
    return found.select("row_id", "evidence_class", "candidate_season", "candidate_team", "candidate_player")


def _players_sql(name: str, source: str) -> str:
    """Diagnosis, evidence and disposition of each unresolved row, every count by a subquery of its own."""
    on = "r.lg = u.lg and r.season = u.season"
    return f"""
with lines as (
  select row_id, lower(league) as lg, league, season, {_value('team_id')} as team, {source} as source, {_value('player_name')} as nm, {_value('player_id')} as player from {name}),
u as (select *, lower(nm) as ex, {_norm('nm')} as no from lines where player is null),
pn as (select trim(player_id, {_STRIP}) as player, min(player_name) as name from players where trim(player_id, {_STRIP}) <> '' group by 1),
r0 as (
  select distinct lower(trim(league, {_STRIP})) as lg, season, trim(team_id, {_STRIP}) as team, trim(player_id, {_STRIP}) as player
  from rosters where trim(player_id, {_STRIP}) <> '' and trim(team_id, {_STRIP}) <> '' and league is not null and season is not null),
r as (select r0.*, lower({_stripped('name')}) as ex, {_norm('name')} as no from r0 left join pn using (player)),
src as (select lg, season, source, count(distinct player) as n from lines where player is not null and source is not null group by all),
c as (
  select u.*,
    (select count(*) from r where {on} and r.team = u.team) as n_roster,
    (select count(distinct player) from r where {on} and r.team = u.team and r.ex = u.ex) as n_exact,
    (select count(distinct player) from r where {on} and r.team = u.team and r.no = u.no) as n_norm,
    coalesce((select n from src where src.lg = u.lg and src.season = u.season and src.source = u.source), 0) as n_source,
    (select count(distinct (team, player)) from r where {on} and r.ex = u.ex and r.team is distinct from u.team) as s_exact,
    (select count(distinct (team, player)) from r where {on} and r.no = u.no and r.team is distinct from u.team) as s_norm,
    (select count(distinct (season, team, player)) from r where r.lg = u.lg and r.ex = u.ex and r.season is distinct from u.season) as o_exact,
    (select count(distinct (season, team, player)) from r where r.lg = u.lg and r.no = u.no and r.season is distinct from u.season) as o_norm,
    (select count(distinct (team, player)) from r
      where {on} and split_part(r.no, ' ', -1) = split_part(u.no, ' ', -1) and substr(r.no, 1, 1) = substr(u.no, 1, 1) and r.team is distinct from u.team) as s_sur
  from u),
x as (
  select row_id, league, season,
    case when lg is null or season is null or team is null then 'MISSING_IDENTITY_CONTEXT' when n_roster = 0 then 'NO_ROSTER_FOR_TEAM_SEASON'
      when nm is null then 'MISSING_PLAYER_NAME' when n_exact = 1 then 'EXACT_NAME_UNIQUE_CANDIDATE' when n_exact > 1 then 'EXACT_NAME_AMBIGUOUS'
      when no is null then 'MISSING_NORMALIZED_NAME' when n_norm = 1 then 'NORMALIZED_NAME_UNIQUE_CANDIDATE' when n_norm > 1 then 'NORMALIZED_NAME_AMBIGUOUS'
      else 'NO_PLAYER_CANDIDATE_ON_ROSTER' end as diagnosis,
    case when n_source = 1 then 'SOURCE_PLAYER_ID_UNIQUE_LINK' when n_source > 1 then 'SOURCE_PLAYER_ID_AMBIGUOUS_LINK'
      when s_exact = 1 then 'POSSIBLE_TEAM_TRANSFER_EXACT_NAME' when s_exact > 1 then 'SAME_SEASON_EXACT_NAME_MULTIPLE_TEAMS'
      when s_norm = 1 then 'POSSIBLE_TEAM_TRANSFER_NORMALIZED_NAME' when s_norm > 1 then 'SAME_SEASON_NORMALIZED_NAME_MULTIPLE_TEAMS'
      when o_exact = 1 then 'PLAYER_EXISTS_OTHER_SEASON_EXACT_NAME' when o_exact > 1 then 'PLAYER_EXISTS_MULTIPLE_OTHER_SEASONS_EXACT_NAME'
      when o_norm = 1 then 'PLAYER_EXISTS_OTHER_SEASON_NORMALIZED_NAME' when o_norm > 1 then 'PLAYER_EXISTS_MULTIPLE_OTHER_SEASONS_NORMALIZED_NAME'
      when s_sur = 1 then 'POSSIBLE_NAME_VARIANT_SURNAME_INITIAL' when s_sur > 1 then 'AMBIGUOUS_SURNAME_INITIAL'
      else 'NO_CROSS_ROSTER_EVIDENCE' end as evidence_class
  from c)
select row_id, league, season, diagnosis, evidence_class,
  case when diagnosis = 'NO_ROSTER_FOR_TEAM_SEASON' then 'SOURCE_ROSTER_MISSING'
    when diagnosis in ('EXACT_NAME_AMBIGUOUS', 'NORMALIZED_NAME_AMBIGUOUS') then 'SOURCE_PLAYER_IDENTITY_AMBIGUOUS'
    when diagnosis in ('MISSING_IDENTITY_CONTEXT', 'MISSING_PLAYER_NAME', 'MISSING_NORMALIZED_NAME') then 'SOURCE_IDENTITY_CONTEXT_MISSING'
    when evidence_class in ('PLAYER_EXISTS_OTHER_SEASON_EXACT_NAME', 'PLAYER_EXISTS_MULTIPLE_OTHER_SEASONS_EXACT_NAME') then 'CROSS_SEASON_IDENTITY_ONLY'
    when evidence_class in ('PLAYER_EXISTS_OTHER_SEASON_NORMALIZED_NAME', 'PLAYER_EXISTS_MULTIPLE_OTHER_SEASONS_NORMALIZED_NAME', 'POSSIBLE_NAME_VARIANT_SURNAME_INITIAL',
      'AMBIGUOUS_SURNAME_INITIAL', 'POSSIBLE_TEAM_TRANSFER_NORMALIZED_NAME', 'SAME_SEASON_NORMALIZED_NAME_MULTIPLE_TEAMS') then 'NAME_VARIANT_REVIEW'
    when evidence_class in ('POSSIBLE_TEAM_TRANSFER_EXACT_NAME', 'SAME_SEASON_EXACT_NAME_MULTIPLE_TEAMS') then 'SOURCE_PLAYER_IDENTITY_AMBIGUOUS'
    when diagnosis = 'NO_PLAYER_CANDIDATE_ON_ROSTER' and evidence_class = 'NO_CROSS_ROSTER_EVIDENCE' then 'SOURCE_PLAYER_NOT_ON_ROSTER' else 'NO_IDENTITY_EVIDENCE' end as disposition
from x"""


_GAMES = _players_sql("player_game_stats", _value("source_player_id"))
_SEASONS = _players_sql("player_season_stats", "cast(null as varchar)")
_TEAMS = f"""
with t as (select lower(trim(league, {_STRIP})) as lg, season, trim(team_id, {_STRIP}) as team, {_stripped('team_name')} as nm from teams where trim(team_id, {_STRIP}) <> ''),
u as (select row_id, lower(league) as lg, season, {_stripped('team_name')} as nm from team_season_stats where {_value('team_id')} is null),
c as (
  select u.*, (select count(distinct team) from t where t.lg = u.lg and t.season = u.season and lower(t.nm) = lower(u.nm)) as n,
    (select count(distinct team) from t where t.lg = u.lg and t.season = u.season and {_norm('t.nm')} = {_norm('u.nm')}) as m from u)
select row_id, case when n = 1 then 'EXACT_TEAM_NAME_UNIQUE_CANDIDATE' when n > 1 then 'EXACT_TEAM_NAME_AMBIGUOUS' when m = 1 then 'NORMALIZED_TEAM_NAME_UNIQUE_CANDIDATE'
  when m > 1 then 'NORMALIZED_TEAM_NAME_AMBIGUOUS' else 'NO_TEAM_CANDIDATE' end as diagnosis
from c"""

_CANDIDATES = f"""
with a as ({_GAMES}),
l as (select row_id, lower(trim(league, {_STRIP})) as lg, season, {_value('team_id')} as team, lower({_value('player_name')}) as ex, {_norm(_value('player_name'))} as no from player_game_stats),
pn as (select trim(player_id, {_STRIP}) as player, min(player_name) as name from players where trim(player_id, {_STRIP}) <> '' group by 1),
r as (
  select distinct lower(trim(league, {_STRIP})) as lg, season, trim(team_id, {_STRIP}) as team, player, lower({_stripped('name')}) as ex, {_norm('name')} as no
  from rosters join pn on trim(rosters.player_id, {_STRIP}) = player where trim(team_id, {_STRIP}) <> '' and league is not null and season is not null)
select a.row_id, evidence_class, cast(r.season as varchar) as candidate_season, r.team as candidate_team, r.player as candidate_player
from a join l using (row_id) join r on r.lg = l.lg and (
  (evidence_class = 'POSSIBLE_TEAM_TRANSFER_EXACT_NAME' and r.season = l.season and r.ex = l.ex and r.team is distinct from l.team)
  or (evidence_class = 'POSSIBLE_TEAM_TRANSFER_NORMALIZED_NAME' and r.season = l.season and r.no = l.no and r.team is distinct from l.team)
  or (evidence_class = 'PLAYER_EXISTS_OTHER_SEASON_EXACT_NAME' and r.season is distinct from l.season and r.ex = l.ex)
  or (evidence_class = 'PLAYER_EXISTS_OTHER_SEASON_NORMALIZED_NAME' and r.season is distinct from l.season and r.no = l.no)
  or (evidence_class = 'POSSIBLE_NAME_VARIANT_SURNAME_INITIAL' and r.season = l.season and r.team is distinct from l.team
    and split_part(r.no, ' ', -1) = split_part(l.no, ' ', -1) and substr(r.no, 1, 1) = substr(l.no, 1, 1)))"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "audit_player_games": audit_player_games,
    "audit_player_seasons": audit_player_seasons,
    "audit_team_seasons": audit_team_seasons,
    "audit_summary": audit_summary,
    "audit_queue": audit_queue,
    "audit_source_ids": audit_source_ids,
    "audit_candidates": audit_candidates,
}
SQL: dict[str, str] = {
    "audit_player_games": f"select row_id, diagnosis, evidence_class, disposition from ({_GAMES})",
    "audit_player_seasons": f"select row_id, row_number() over (partition by league, season order by row_id) as audit_row, diagnosis, evidence_class, disposition from ({_SEASONS})",
    "audit_team_seasons": _TEAMS,
    "audit_summary": f"select disposition, diagnosis, count(*) as count from ({_GAMES}) group by all",
    "audit_queue": f"""select 'player_game_stats' as dataset, row_id, disposition from ({_GAMES}) union all select 'player_season_stats', row_id, disposition from ({_SEASONS})
      union all select 'team_season_stats', row_id, 'TEAM_SOURCE_UNRESOLVED' from team_season_stats where {_value('team_id')} is null""",
    "audit_source_ids": f"""select league, season, {_value('source_player_id')} as source_player_id, count(*) as n_rows, count(distinct {_value('team_id')}) as n_teams, count(distinct {_value('player_name')}) as n_names
      from player_game_stats where {_value('player_id')} is null and {_value('source_player_id')} is not null group by all""",
    "audit_candidates": _CANDIDATES,
}
