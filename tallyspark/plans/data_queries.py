"""The registered queries of the general data operators, and the SQL to compare them with."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import broken_lines, profile, references, schema_drift
from ..sources.tables import table

REFERENCE_TABLES = ("player_season_stats", "team_season_stats", "player_game_stats", "players", "teams", "games")

# The ranges in which the profiled columns are right.
PROFILE_RANGES = {("games", "week"): (1, 20), ("standings", "wins"): (0, 20), ("standings", "win_pct"): (0, 1)}
DOMAIN_TABLES = ("teams", "players", "rosters", "games", "player_game_stats", "player_season_stats", "team_season_stats", "standings")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, parents = references.league_references({t: table(spark, sf_dir, t) for t in REFERENCE_TABLES})
    return references.orphan_references(refs, parents)


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_report(p1_found(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_lines.load_report_lines(table(spark, sf_dir, "recovery_lines")).where("reason is not null").select("line_id")


def p2_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_lines.load_report_lines(table(spark, sf_dir, "recovery_lines")).where("reason is not null").select("line_id", "reason")


def p2_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_lines.load_report_lines(table(spark, sf_dir, "recovery_lines")).where("reason is null").drop("reason")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = schema_drift.load_cells(table(spark, sf_dir, "feed_rows"))
    return schema_drift.schema_changes(cells).select("file_id", "change_kind", "old_name", "new_name")


def _feed(feed: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return schema_drift.DriftedFeeds(table(spark, sf_dir, "feed_rows")).table(feed)

    return run


def p3_failed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_drift.DriftedFeeds(table(spark, sf_dir, "feed_rows")).failed_casts()


def _load_of(df: DataFrame) -> tuple[Column, tuple[str, ...]]:
    """What counts as the load of a row, and the columns that say just that: load_id, else the feed, else the month of loaded_at in UTC."""
    for name in ("load_id", "feed"):
        if name in df.columns:
            return F.col(name), (name,)
    return F.date_format("loaded_at", "yyyy-MM"), ()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = []
    for name in dict.fromkeys(t for t, _ in PROFILE_RANGES):
        counts.append(profile.value_counts(table(spark, sf_dir, name), name, [c for t, c in PROFILE_RANGES if t == name], F.col("load_id")))
    return profile.failed_loads(reduce(DataFrame.unionByName, counts), PROFILE_RANGES)


def p4_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the eight domain tables."""
    tables = {t: table(spark, sf_dir, t) for t in DOMAIN_TABLES}
    counts = reduce(DataFrame.unionByName, [profile.value_counts(df, t, df.columns) for t, df in tables.items()])
    shown = ["table_name", "column_name", "n_rows", "n_null", "n_distinct", "min_number", "max_number", "main_form", "n_forms", "n_main_form", "n_off_form"]
    return profile.column_profile(counts).select(*shown, F.round("null_share", 6).alias("null_share"), F.round("off_form_share", 6).alias("off_form_share"))


def p4_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change of every column of the domain tables between loads; the columns that name the load are left out."""
    counts, sizes = [], []
    for name in DOMAIN_TABLES:
        df = table(spark, sf_dir, name)
        load, own = _load_of(df)
        columns = [c for c in df.columns if c not in own]
        counts.append(profile.value_counts(df, name, columns, load))
        sizes.append(profile.load_sizes(df, name, columns, load))
    changed = profile.population_stability(reduce(DataFrame.unionByName, counts), reduce(DataFrame.unionByName, sizes))
    return changed.select("table_name", "column_name", "load_id", "n_load", F.round("psi", 6).alias("psi"), F.round("chi_square", 3).alias("chi_square"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_report": p1_report,
    "p2_found": p2_found,
    "p2_reasons": p2_reasons,
    "p2_valid": p2_valid,
    "p3_found": p3_found,
    "p3_standings": _feed("standings"),
    "p3_player_game_stats": _feed("player_game_stats"),
    "p3_recovery_report": _feed("recovery_report"),
    "p3_failed_casts": p3_failed_casts,
    "p4_found": p4_found,
    "p4_profile": p4_profile,
    "p4_change": p4_change,
}

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160)"
_TOKENS = "'', '-', 'NULL', 'null', 'None', 'Not Reported', 'N/A', 'NR'"


def _id(column: str) -> str:
    return f"case when trim({column}, {_BLANKS}) not in ({_TOKENS}) then upper(trim({column}, {_BLANKS})) end"


def _orphans(child: str, parent: str, id_column: str, scoped: bool) -> str:
    scope = "p.league = c.league and p.season = c.season and " if scoped else ""
    return (
        f"select '{child}' as table_name, c.season, c.row_id from (select *, {_id(id_column)} as k from {child}) c where c.k is not null and not exists "
        f"(select 1 from (select *, {_id(id_column)} as k from {parent}) p where {scope}p.k = c.k and p.loaded_at <= c.loaded_at and (p.deleted_at is null or p.deleted_at > c.loaded_at))"
    )


P1_SQL = " union all ".join(
    (
        _orphans("player_season_stats", "players", "player_id", False),
        _orphans("team_season_stats", "teams", "team_id", True),
        _orphans("player_game_stats", "games", "game_id", True),
    )
)


# The fields of a recovery report record in order, its endpoints and categories; a field of RFC 4180.
_P2_FIELDS = (
    "source_file", "recovered_file", "league", "season", "endpoint", "resource_id", "category", "success", "recovery_rule", "parse_error", "source_size_bytes", "output_size_bytes",
)
_P2_ENDPOINTS = "teams team_stats offensive_stats defensive_stats scoring_stats special_teams_stats schedule standings rosters games players player_stats stats".split()
_P2_CATEGORIES = "MALFORMED_GAME_DATA MALFORMED_STANDINGS_DATA PYTHON_LITERAL EMPTY_PLAYER_STATS VALID_JSON UNSUPPORTED".split()
_P2_FIELD = r"""(?:[^",\r\n]*|"(?:[^"]|"")*")"""


def _among(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _unquoted(c: str) -> str:
    return f"case when f.{c} like '\"%' then replace(substr(f.{c}, 2, length(f.{c}) - 2), '\"\"', '\"') else f.{c} end as {c}"


# Lines told apart by one pattern; of lines of twelve fields the fields unquoted; the first rule a line breaks.
_P2_LINES = f"""
with t as (
  select line_id, line_text, coalesce(regexp_full_match(line_text, '{_P2_FIELD}(?:,{_P2_FIELD})*'), false) and not contains(line_text, chr(0)) as quoted_well,
    length(regexp_replace(line_text, '"(?:[^"]|"")*"|[^,]', '', 'g')) + 1 as n_fields from recovery_lines),
x as (
  select *, case when quoted_well and n_fields = 12 then regexp_extract(line_text, '^{",".join([f"({_P2_FIELD})"] * 12)}$', [{", ".join(f"'{c}'" for c in _P2_FIELDS)}]) end as f from t),
v as (select line_id, line_text, quoted_well, n_fields, {", ".join(_unquoted(c) for c in _P2_FIELDS)} from x),
told as (
  select *, case when line_text is null or line_text = '' then 'empty record' when not quoted_well then 'broken quoting'
    when n_fields < 12 then 'too few fields' when n_fields > 12 then 'too many fields'
    when source_file = '' then 'source_file is empty'
    when season <> '' and not regexp_full_match(season, '[0-9]{{4}}') then 'season is not four digits'
    when endpoint not in {_among(_P2_ENDPOINTS)} then 'endpoint is unknown'
    when category not in {_among(_P2_CATEGORIES)} then 'category is unknown'
    when lower(success) not in ('true', 'false') then 'success is not a boolean'
    when not regexp_full_match(source_size_bytes, '[0-9]+') or try_cast(source_size_bytes as bigint) is null then 'source_size_bytes is not a long'
    when output_size_bytes <> '' and (not regexp_full_match(output_size_bytes, '[0-9]+') or try_cast(output_size_bytes as bigint) is null) then 'output_size_bytes is not a long' end as reason
  from v)"""


def _typed_field(c: str) -> str:
    if c == "success":
        return "lower(success) = 'true' as success"
    return f"cast(nullif({c}, '') as bigint) as {c}" if c in ("season", "source_size_bytes", "output_size_bytes") else f"nullif({c}, '') as {c}"


# The other names the fields of each feed go by in the smaller test tables, and the columns of the feeds' tables with their types there.
_FEED_NAMES = {
    "standings": {"victories": "w", "winning_percentage": "win_pct", "defeats": "l", "scored": "pf", "current_run": "streak", "club": "team_name"},
    "player_game_stats": {"total_tackles": "tackles", "yds_rush": "rush_yards", "player_id": "source_player_id", "full_name": "player_name", "jersey": "number"},
    "recovery_report": {
        "size": "source_size_bytes", "bytes_in": "source_size_bytes", "resource": "endpoint", "api_method": "endpoint", "path": "source_file",
        "problem_class": "category", "message": "parse_error", "rule_applied": "recovery_rule",
    },
}
_FEED_TYPES = {
    "standings": {"varchar": "home streak team_name tier", "bigint": "l pf w", "double": "pa win_pct"},
    "player_game_stats": {"varchar": "game_id player_name team_name", "bigint": "qb_hits rush_yards snap_count tackles", "double": "number source_player_id", "boolean": "started"},
    "recovery_report": {"varchar": "attempt_label category encoding endpoint parse_error recovered_by recovery_rule source_file", "double": "elapsed source_size_bytes", "boolean": "success"},
}


def _feed_sql(feed: str) -> str:
    """One row per record, its last delivery, the fields under the names they are known by."""
    renamed = " ".join(f"when name = '{old}' then '{new}'" for old, new in _FEED_NAMES[feed].items())
    columns = [f"max(try_cast(value as {kind})) filter (name = '{c}') as {c}" for kind, names in _FEED_TYPES[feed].items() for c in names.split()]
    return f"""
with given as (select * from feed_rows where feed = '{feed}' and stream_id is not null and file_id is not null and coalesce(json_type(try_cast(payload as json)) = 'OBJECT', false)),
whole as (select stream_id, file_id, rec_no, arg_max(row_id, (delivered_at, row_id)) as row_id, max(as_of) as as_of from given group by all),
keys as (select row_id, payload, unnest(json_keys(payload)) as k from given where row_id in (select row_id from whole)),
cells as (select row_id, trim(regexp_replace(regexp_replace(lower(trim(k)), '[\\s-]', '_', 'g'), '_+', '_', 'g'), '_') as name, json_extract_string(payload, '$."' || k || '"') as value from keys),
named as (select row_id, case {renamed} else name end as name, value from cells where value is not null and {_valued('value')}),
fields as (select row_id, {", ".join(columns)} from named group by row_id)
select whole.*, fields.* exclude (row_id) from whole left join fields using (row_id)"""


def _valued(c: str) -> str:
    return f"trim({c}, {_BLANKS}) not in ({_TOKENS})"


P4_SQL = """
with v as (
  select 'games' as table_name, load_id, 'week' as column_name, cast(week as double) as x, 1 as lo, 20 as hi from games
  union all select 'standings', load_id, 'wins', cast(wins as double), 0, 20 from standings
  union all select 'standings', load_id, 'win_pct', win_pct, 0, 1 from standings),
loads as (
  select table_name, column_name, load_id, count(*) as n, count(x) as f, count(*) - count(x) as nulls,
    count(*) filter (where x < lo or x > hi) as outside, count(distinct x) as different from v group by all),
own as (select table_name, column_name, load_id, x, count(*) as c from v where x is not null group by all),
spots as (select distinct table_name, column_name, x from own),
grid as (select l.table_name, l.column_name, l.load_id, l.f, s.x from loads l join spots s using (table_name, column_name)),
steps as (
  select g.*, coalesce(o.c, 0) as c, sum(coalesce(o.c, 0)) over (partition by table_name, column_name, load_id order by x) as upto
  from grid g left join own o using (table_name, column_name, load_id, x)),
both_sides as (
  select *, sum(upto) over (partition by table_name, column_name, x) as all_upto, sum(f) over (partition by table_name, column_name, x) as all_f from steps),
gaps as (
  select table_name, column_name, load_id, bool_or(f > 0 and all_f > f and abs(upto * (all_f - f) - (all_upto - upto) * f) * 20 >= 9 * f * (all_f - f)) as departs
  from both_sides group by all)
select l.table_name, coalesce(l.load_id, '') as load_id, l.column_name from loads l left join gaps g on g.table_name = l.table_name and g.column_name = l.column_name and g.load_id is not distinct from l.load_id
where nulls * 5 >= n or (f > 0 and outside * 10 >= f) or different < 3 or coalesce(departs, false)
"""


# The statistics that both tables of players have, and those of seasons alone.
_GAME_NUMBERS = """passing_attempts passing_completions passing_yards pass_tds passing_interceptions rushing_carries rushing_yards receiving_catches receiving_yards
receiving_tds tackles tackle_assists tackles_combined sacks interceptions fg_made fg_attempts total_points"""
_SEASON_NUMBERS = """passing_long completion_pct passing_average passer_rating tackles_for_loss forced_fumbles fumble_recoveries passes_deflected blocked_kicks kickoff_returns
kickoff_return_yards kickoff_return_tds punt_returns punt_return_yards punt_return_tds interception_return_yards interception_return_tds fumble_recovery_yards
fumble_recovery_tds pat_made pat_attempts punts punt_yards tds two_point_conversions safety"""

# The columns of the domain tables by how their numbers are read, and what counts as the load of a row.
_PROFILED = {
    "teams": {"number": "season", "timestamp": "loaded_at deleted_at", "text": "league team_id team_number team_city team_name tier conference division region"},
    "players": {"timestamp": "loaded_at deleted_at", "text": "player_id player_name height weight school hometown"},
    "rosters": {"number": "season", "timestamp": "loaded_at", "text": "league team_id team_name player_id roster_number position"},
    "games": {"number": "season week visitor_score home_score", "date": "date", "timestamp": "loaded_at deleted_at", "text": "league game_id season_type visitor_team_name home_team_name load_id"},
    "player_game_stats": {
        "number": f"row_id season week {_GAME_NUMBERS}", "date": "date", "timestamp": "loaded_at",
        "text": "league game_id team_id team_name opponent_id opponent_name home_away source_player_id player_name roster_number player_id feed",
    },
    "player_season_stats": {"number": f"row_id season {_GAME_NUMBERS} {_SEASON_NUMBERS}", "timestamp": "loaded_at", "text": "league player_id team_id player_name team_city team_name"},
    "team_season_stats": {"number": f"row_id season {_GAME_NUMBERS}", "timestamp": "loaded_at", "text": "team_name team_city league team_id team_logo team_number"},
    "standings": {
        "number": "season wins losses ties win_pct points_for points_against", "timestamp": "loaded_at",
        "text": "league tier conference division region team_name team_logo home_record away_record conference_record division_record nonconference_record nondivision_record streak load_id",
    },
}
_LOADS = {"games": "load_id", "standings": "load_id", "player_game_stats": "feed"}
_READ = {
    "number": ("cast({c} as varchar)", "cast({c} as double)"),
    "date": ("cast({c} as varchar)", "cast(epoch_us(cast({c} as timestamp)) as double)"),
    "timestamp": ("cast({c} at time zone 'UTC' as varchar)", "cast(epoch_us({c}) as double)"),
    "text": ("{c}", "cast(null as double)"),
}


def _cells(table_name: str) -> str:
    """One scan of a table, its columns unpivoted to (load_id, column_name, value, number)."""
    load = _LOADS.get(table_name, "strftime(loaded_at at time zone 'UTC', '%Y-%m')")
    pieces = ", ".join(f"{{'column_name': '{c}', 'value': {_READ[kind][0].format(c=c)}, 'number': {_READ[kind][1].format(c=c)}}}" for kind, columns in _PROFILED[table_name].items() for c in columns.split())
    return f"select '{table_name}' as table_name, load_id, p.column_name, p.value, p.number from (select {load} as load_id, unnest([{pieces}]) as p from {table_name})"


_CELLS = " union all ".join(_cells(t) for t in _PROFILED)
P4_PROFILE_SQL = rf"""
with v as ({_CELLS}),
f as (
  select table_name, column_name, regexp_replace(regexp_replace(regexp_replace(value, '\p{{L}}+', 'a', 'g'), '[0-9]+', '9', 'g'), '\s+', ' ', 'g') as form, count(*) as n
  from v where value is not null group by all),
m as (select table_name, column_name, arg_max(form, (n, form)) as main_form, count(*) as n_forms, cast(max(n) as bigint) as n_main_form from f group by all),
c as (
  select table_name, column_name, count(*) as n_rows, count(*) - count(value) as n_null, count(distinct value) as n_distinct, min(number) as min_number, max(number) as max_number
  from v group by all)
select c.*, main_form, n_forms, n_main_form, n_rows - n_null - coalesce(n_main_form, 0) as n_off_form, round(n_null / n_rows, 6) as null_share,
  case when n_rows > n_null then round((n_rows - n_null - coalesce(n_main_form, 0)) / (n_rows - n_null), 6) end as off_form_share
from c left join m using (table_name, column_name)
"""

# the index and chi-square of each load, value by value: every value of a column beside every load of it
P4_CHANGE_SQL = f"""
with v as ({_CELLS}),
own as (select table_name, column_name, coalesce('=' || load_id, '') as load, coalesce('=' || value, '') as v, count(*) as n from v
  where not ((table_name in ('games', 'standings') and column_name = 'load_id') or (table_name = 'player_game_stats' and column_name = 'feed')) group by all),
loads as (select table_name, column_name, load, sum(n) as n_load from own group by all),
totals as (select table_name, column_name, v, sum(n) as n_all from own group by all),
sizes as (select table_name, column_name, sum(n_all) as n_table from totals group by all),
g as (
  select l.table_name, l.column_name, l.load, n_load, cast(n_all as double) as a, coalesce(n, 0) as n, n_table, n_table - n_load as rest
  from loads l join sizes using (table_name, column_name) join totals t using (table_name, column_name) left join own o using (table_name, column_name, load, v) where n_table > n_load),
s as (select *, greatest(n / n_load, 1e-4) as p, greatest((a - n) / rest, 1e-4) as q, a * n_load / n_table as e, a * rest / n_table as er from g)
select table_name, column_name, case when load <> '' then substr(load, 2) end as load_id, cast(any_value(n_load) as bigint) as n_load, round(sum((p - q) * ln(p / q)), 6) as psi,
  round(sum((n - e) * (n - e) / e + (a - n - er) * (a - n - er) / er), 3) as chi_square
from s group by table_name, column_name, load
"""

SQL: dict[str, str] = {
    "p1_found": P1_SQL,
    "p1_report": f"select table_name, season, cast(count(*) as bigint) as n_orphans from ({P1_SQL}) group by all",
    "p2_found": f"{_P2_LINES} select line_id from told where reason is not null",
    "p2_reasons": f"{_P2_LINES} select line_id, reason from told where reason is not null",
    "p2_valid": f"{_P2_LINES} select line_id, {', '.join(_typed_field(c) for c in _P2_FIELDS)} from told where reason is null",
    **{f"p3_{feed}": _feed_sql(feed) for feed in _FEED_TYPES},
    "p4_found": P4_SQL,
    "p4_profile": P4_PROFILE_SQL,
    "p4_change": P4_CHANGE_SQL,
}
