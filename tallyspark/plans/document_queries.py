"""Queries over nested documents: the tables are written as documents of the source's kinds, flattened and resolved again, and compared with SQL over the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import valued
from ..sources.tables import table
from .canonical import Canonical

_DOCUMENT = "league string, season long, endpoint string, resource_id string, file string, text string"


def _documents(rows: DataFrame, endpoint: str, keys: list[str], body: Callable[[Column], Column], record: Column, resource: Column | None = None, parts: int = 8) -> DataFrame:
    """One document per ``keys`` and share of the records, so that none grows with the table; ``body`` puts the list of records where it belongs."""
    share = F.pmod(F.xxhash64(F.to_json(record)), F.lit(parts)).alias("share")
    lists = rows.groupBy(*keys, share).agg(F.sort_array(F.collect_list(F.to_json(record))).alias("records"))
    records = F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))
    own = (resource if resource is not None else F.lit(None)).cast("string")
    return lists.select("league", F.col("season").cast("long").alias("season"), F.lit(endpoint).alias("endpoint"), own.alias("resource_id"), F.concat_ws("/", F.lit(endpoint), F.to_json(F.struct(*keys)), "share").alias("file"), body(records).alias("text"))


def _listed(name: str) -> Callable[[Column], Column]:
    return lambda records: F.concat(F.lit(f'{{"data": {{"{name}": '), records, F.lit("}}"))


def _scoped(df: DataFrame) -> DataFrame:
    return df.where("league is not null and season is not null")


def schedule_documents(games: DataFrame) -> DataFrame:
    """Weeks with their games; a week of the regular season has a week_number, others a psw."""
    game = F.to_json(F.struct(F.col("game_id").alias("game12"), F.col("date").cast("string").alias("Date"), F.col("visitor_team_name").alias("Visitor"), F.col("visitor_score").alias("Visitor Score"), F.col("home_team_name").alias("home"), F.col("home_score").alias("home-score")))
    regular = F.coalesce(F.col("season_type") == "regular", F.lit(False))
    weeks = _scoped(games).groupBy("league", "season", regular.alias("regular"), "week", F.pmod(F.xxhash64(game), F.lit(4)).alias("part")).agg(F.sort_array(F.collect_list(game)).alias("games"))
    number = F.when(F.col("week").isNotNull(), F.concat(F.lit('"'), F.when(F.col("regular"), "Week Number").otherwise("PSW"), F.lit('": "'), F.col("week").cast("string"), F.lit('", '))).otherwise("")
    week = F.concat(F.lit("{"), number, F.lit('"games": ['), F.array_join("games", ","), F.lit("]}"))
    lists = weeks.groupBy("league", "season", "part").agg(F.sort_array(F.collect_list(week)).alias("weeks"))
    text = F.concat(F.lit('{"x": [], "schedule_games": ['), F.array_join("weeks", ","), F.lit("]}"))
    return lists.select("league", F.col("season").cast("long").alias("season"), F.lit("schedule").alias("endpoint"), F.lit(None).cast("string").alias("resource_id"), F.concat_ws("/", "league", "season", "part").alias("file"), text.alias("text"))


GAME_LINE = ("source_player_id", "player_name", "roster_number", "rushing_yards", "tackles_combined")
_SIDE = ("game_id", "team_id", "team_name", "opponent_id", "opponent_name")


def game_documents(stats: DataFrame) -> DataFrame:
    """One document per game and side, its lines under keys of players' numbers."""
    rows = _scoped(stats).where("home_away in ('home', 'visitor')")
    line = F.struct(F.col("source_player_id").alias("Player ID"), F.col("player_name").alias("Player Name"), F.col("roster_number").alias("Roster-Number"), F.col("rushing_yards").alias("Rushing  Yards"), F.col("tackles_combined").alias("tackles_combined"))
    home = F.col("home_away") == "home"

    def body(records: Column) -> Column:
        def side(name: str) -> Column:
            return F.when(home, F.concat(F.lit("home"), F.lit(name))).otherwise(F.concat(F.lit("visitor"), F.lit(name)))

        def other(name: str) -> Column:
            return F.when(home, F.concat(F.lit("visitor"), F.lit(name))).otherwise(F.concat(F.lit("home"), F.lit(name)))

        head = F.to_json(F.create_map(side("_team_id"), F.col("team_id"), side("_team"), F.col("team_name"), other("_team_id"), F.col("opponent_id"), other("_team"), F.col("opponent_name")))
        return F.concat(F.lit('{"game_data": ['), head, F.lit('], "'), side("_stats"), F.lit('": [{"player_number_7": '), records, F.lit("}]}"))

    return _documents(rows, "games", ["league", "season", "home_away", *_SIDE], body, line, F.col("game_id"), 1)


def team_documents(teams: DataFrame) -> DataFrame:
    kept = _scoped(teams).where("team_id is not null").groupBy("league", "season", "team_id").agg(F.min("team_city").alias("team_city"), F.min("team_name").alias("team_name"))
    return _documents(kept, "teams", ["league", "season"], _listed("league_teams_list"), F.struct(F.col("team_id").alias("id"), F.col("team_city").alias("City"), F.col("team_name").alias("Name")))


def roster_documents(rosters: DataFrame, players: DataFrame) -> DataFrame:
    """Each roster with the smallest name of each of its players."""
    names = players.where("player_id is not null").groupBy("player_id").agg(F.min("player_name").alias("player_name"))
    people = _scoped(rosters).where("team_id is not null and player_id is not null").select("league", "season", "team_id", "player_id").distinct().join(names, "player_id")

    def body(records: Column) -> Column:
        return F.concat(F.lit('{"League": "'), F.col("league"), F.lit('", "season": '), F.col("season").cast("string"), F.lit(', "team": "x", "players": '), records, F.lit("}"))

    return _documents(people, "rosters", ["league", "season", "team_id"], body, F.struct(F.col("player_id").alias("player31"), F.col("player_name").alias("Name")), F.col("team_id"))


def team_stat_documents(stats: DataFrame) -> DataFrame:
    return _documents(_scoped(stats), "team_stats", ["league", "season"], lambda records: F.concat(F.lit('{"a": [{"no": 1}], "stats": '), records, F.lit("}")), F.struct(F.col("row_id").cast("string").alias("Row ID"), F.col("team_city").alias("Team City"), F.col("team_name").alias("team-name"), F.col("team_id").alias("team_id"), F.col("total_points").alias("Total Points")))


CATEGORY_FIELDS = {"offensive_stats": ("rushing_yards", "total_points"), "defensive_stats": ("tackles", "total_points")}


def category_documents(stats: DataFrame) -> list[DataFrame]:
    """Two files a season, each with fields of its own and one of both; of a field of both the later file's value holds."""
    key = ["league", "season", "team_city", "team_name", "player_name"]
    rows = _scoped(stats).withColumns({c: valued(c) for c in key[2:]}).where("player_name is not null and team_name is not null")
    out = []
    for endpoint, fields in CATEGORY_FIELDS.items():
        of = F.max if endpoint == "defensive_stats" else F.min
        one = rows.groupBy(*key).agg(*[of(f).alias(f) for f in fields])
        record = F.struct(F.col("player_name").alias("Player Name"), F.col("team_city").alias("Team City"), F.col("team_name").alias("Team Name"), F.lit("3").alias("Rank"), *[F.col(f) for f in fields])
        out.append(_documents(one, endpoint, ["league", "season"], lambda records: F.concat(F.lit('{"leaders": {"deep": [{"list": '), records, F.lit("}]}}")), record))
    return out


def standing_documents(standings: DataFrame) -> DataFrame:
    """Standings below their labels: wfa by tier, conference and region, wnfc by division."""
    labels = F.when(F.col("league") == "wfa", F.array(F.lit("Default Region"), "tier", "conference", "region")).otherwise(F.array(F.lit("League Standings"), "division"))
    keyed = _scoped(standings).withColumn("labels", F.to_json(F.filter(labels, lambda x: x.isNotNull())))
    record = F.struct(F.col("team_name").alias("Team Name"), F.col("wins").alias("W"), F.col("losses").alias("L"), F.col("ties").alias("T"), F.col("win_pct").alias("PCT"), F.col("points_for").alias("PF"), F.col("streak").alias("Streak"))

    def body(records: Column) -> Column:
        path = F.from_json("labels", "array<string>")
        opened = F.aggregate(path, F.lit(""), lambda a, x: F.concat(a, F.lit("{"), F.to_json(F.array(x)), F.lit(": ")))
        # a JSON array of one label holds the key between its brackets
        opened = F.regexp_replace(opened, r'\["|"\]', '"')
        return F.concat(opened, records, F.repeat(F.lit("}"), F.size(path)))

    # a record needs both numbers under their keys to be one
    return _documents(keyed.where("wins is not null and losses is not null and team_name is not null"), "standings", ["league", "season", "labels"], body, record)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160)"
_TOKENS = "'', '-', 'NULL', 'null', 'None', 'Not Reported', 'N/A', 'NR'"


def _value(c: str) -> str:
    return f"case when trim({c}, {_BLANKS}) not in ({_TOKENS}) then trim({c}, {_BLANKS}) end"


def _query(sql: str) -> Callable[[Callable], Callable]:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


@_query(f"""
select league, season, {_value('game_id')} as game_id, case when week is not null then case when season_type = 'regular' then 'regular' else 'postseason' end end as season_type, week, date,
  {_value('visitor_team_name')} as visitor_team_name, visitor_score, {_value('home_team_name')} as home_team_name, home_score from games where league is not null and season is not null
""")
def flatten_schedule(spark, d):
    """Weeks and their games, at two levels."""
    flat = Canonical(schedule_documents(table(spark, d, "games")))
    fields = ["game_id", "season_type", "week", "date", "visitor_team_name", "visitor_score", "home_team_name", "home_score"]
    rows = flat.rows("games", fields)
    return rows.select("league", "season", *[F.col(c).try_cast("bigint" if c in ("week", "visitor_score", "home_score") else "date" if c == "date" else "string").alias(c) for c in fields])


@_query(f"""
select league, season, game_id, home_away, {', '.join(f'{_value(c)} as {c}' for c in (*_SIDE[1:], *GAME_LINE[:3]))}, rushing_yards, tackles_combined
from player_game_stats where league is not null and season is not null and home_away in ('home', 'visitor')
""")
def flatten_games(spark, d):
    """Lines of players below the sides of games."""
    fields = [*_SIDE, "home_away", *GAME_LINE]
    rows = Canonical(game_documents(table(spark, d, "player_game_stats"))).rows("player_game_stats", fields)
    return rows.select("league", "season", *[F.col(c).try_cast("double" if c in GAME_LINE[3:] else "string").alias(c) for c in fields])


_TEAM_KEYS = ("league", "season", "team_city", "team_name")
_TEAM_LOOKUP = f"""
kept as (select league, season, {_value('team_id')} as team_id, {_value('min(team_city)')} as team_city, {_value('min(team_name)')} as team_name
  from teams where league is not null and season is not null and team_id is not null group by league, season, teams.team_id),
lookup as (select league, season, team_city, team_name, min(team_id) as found from kept group by all)"""


@_query(f"""
with {_TEAM_LOOKUP},
s as (select row_id, league, season, {_value('team_city')} as team_city, {_value('team_name')} as team_name, {_value('team_id')} as team_id, total_points
  from team_season_stats where league is not null and season is not null and team_name is not null)
select cast(row_id as varchar) as row_id, s.league, s.season, s.team_city, s.team_name, coalesce(s.team_id, found) as team_id, total_points
from s left join lookup l on s.league = l.league and s.season = l.season and s.team_city = l.team_city and s.team_name = l.team_name
""")
def resolve_team_seasons(spark, d):
    """Statistics of teams from lists below the document's top, their ids filled in by city and name."""
    docs = team_stat_documents(table(spark, d, "team_season_stats")).unionByName(team_documents(table(spark, d, "teams")))
    return Canonical(docs).team_season_stats().select(F.col("row_id").cast("bigint").cast("string").alias("row_id"), *_TEAM_KEYS, "team_id", "total_points")


_NAMES = f"""
people as (select player_id, {_value('min(player_name)')} as name from players where player_id is not null group by player_id),
members as (select distinct league, season, team_id, {_value('r.player_id')} as player_id, lower(name) as name_key
  from rosters r join people p on p.player_id = r.player_id where league is not null and season is not null and team_id is not null),
best as (select player_id, min(name) as name from (select {_value('player_id')} as player_id, name from people) group by 1),
named as (select league, season, team_id, min(player_id) as found from members where name_key is not null and player_id is not null group by league, season, team_id, name_key having count(distinct player_id) = 1)"""


@_query(f"""
with {_NAMES.replace('select league, season, team_id, min', 'select league, season, team_id, name_key, min')},
lines as (select distinct league, season, game_id, {', '.join(f'{_value(c)} as {c}' for c in (*_SIDE[1:], *GAME_LINE[:3]))}, home_away, rushing_yards + 0.0 as rushing_yards, tackles_combined + 0.0 as tackles_combined
  from player_game_stats where league is not null and season is not null and home_away in ('home', 'visitor')),
first as (select l.*, found as player_id from lines l left join named n on l.league = n.league and l.season = n.season and l.team_id = n.team_id and lower(l.player_name) = n.name_key),
sources as (select league, season, source_player_id, min(player_id) as by_source from first where source_player_id is not null and player_id is not null group by all having count(distinct player_id) = 1)
select f.league, f.season, game_id, team_id, f.source_player_id, player_name, rushing_yards, coalesce(player_id, by_source) as player_id
from first f left join sources s on f.league = s.league and f.season = s.season and f.source_player_id = s.source_player_id
""")
def resolve_player_games(spark, d):
    """Lines of players in games: the roster's unique name first, then what the source id's other lines were resolved to."""
    docs = game_documents(table(spark, d, "player_game_stats")).unionByName(roster_documents(table(spark, d, "rosters"), table(spark, d, "players")))
    return Canonical(docs).player_game_stats().select("league", "season", "game_id", "team_id", "source_player_id", "player_name", "rushing_yards", "player_id")


@_query(f"""
with {_TEAM_LOOKUP}, {_NAMES.replace('select league, season, team_id, min', 'select league, season, team_id, name_key, min')},
s as (select league, season, {_value('team_city')} as team_city, {_value('team_name')} as team_name, {_value('player_name')} as player_name,
    min(rushing_yards) as rushing_yards, max(tackles) as tackles, max(total_points) as total_points from player_season_stats
  where league is not null and season is not null and {_value('player_name')} is not null and {_value('team_name')} is not null group by all),
w as (select s.*, found as team_id from s left join lookup l on s.league = l.league and s.season = l.season and s.team_city = l.team_city and s.team_name = l.team_name)
select w.league, w.season, team_city, team_name, player_name, rushing_yards, tackles, total_points, w.team_id, n.found as player_id
from w left join named n on w.league = n.league and w.season = n.season and w.team_id = n.team_id and lower(w.player_name) = n.name_key
""")
def resolve_player_seasons(spark, d):
    """Seasons of players merged from two files, the last value given per field, then team and player by their names."""
    docs = team_documents(table(spark, d, "teams")).unionByName(roster_documents(table(spark, d, "rosters"), table(spark, d, "players")))
    for own in category_documents(table(spark, d, "player_season_stats")):
        docs = docs.unionByName(own)
    shown = ["league", "season", "team_city", "team_name", "player_name", "rushing_yards", "tackles", "total_points", "team_id", "player_id"]
    return Canonical(docs).player_season_stats().select(*shown)


@_query(f"""
select league, season, {_value('team_name')} as team_name, wins, losses, ties, win_pct, points_for, {_value('streak')} as streak,
  case when league = 'wfa' then tier end as tier, case when league = 'wfa' then conference end as conference, case when league = 'wnfc' then division end as division, case when league = 'wfa' then region end as region
from (select * replace (
    case when upper(trim(tier)) = 'WFA PRO' or upper(trim(tier)) like 'DIV %' then trim(tier) end as tier, case when upper(trim(conference)) like '%CONFERENCE' then trim(conference) end as conference,
    case when upper(trim(division)) like '%DIVISION' then trim(division) end as division, case when upper(trim(region)) like '%REGION' then trim(region) end as region) from standings)
where league is not null and season is not null and team_name is not null and wins is not null and losses is not null
""")
def flatten_standings_walk(spark, d):
    """Standings below labels, which tell tier, conference, division and region."""
    shown = ["team_name", "wins", "losses", "ties", "win_pct", "points_for", "streak", "tier", "conference", "division", "region"]
    return Canonical(standing_documents(table(spark, d, "standings"))).standings().select("league", "season", *shown)
