"""The registered queries of the staging, intermediate and mart layers, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from .models import CAREER_RATIOS, CAREER_SUMS, KEPT_BY, LEAGUES, STAGED, Models

_COLUMNS = {
    "teams": "league season team_id team_number team_city team_name tier conference division region loaded_at deleted_at",
    "players": "player_id player_name height weight school hometown loaded_at deleted_at",
    "rosters": "league season team_id team_name player_id roster_number position loaded_at",
    "games": "league season game_id season_type week date visitor_team_name visitor_score home_team_name home_score load_id loaded_at deleted_at",
}


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(Models.of(spark, sf_dir), name)()


def _staged(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: Models({name: table(spark, sf_dir, name).drop("loaded_at", "deleted_at")}).staging(name)


def _league(league: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: Models.of(spark, sf_dir).league_view(league, name)


INTERMEDIATE = ("int_player_games", "int_player_seasons", "int_roster_memberships", "int_team_games", "int_team_seasons")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = (
    {f"stg_{name}": _staged(name) for name in STAGED}
    | {name: _model(name) for name in (*INTERMEDIATE, *Models.CORE)}
    | {name.replace("mart_", f"mart_{league}_", 1): _league(league, name) for league in LEAGUES for name in Models.CORE}
)


def _dimension(name: str) -> str:
    order = ", ".join(f"{c} nulls first" for c in ["loaded_at", *_COLUMNS[name].split()])
    gone = "loaded_at, deleted_at" if "deleted_at" in _COLUMNS[name] else "loaded_at"
    return f"d_{name} as (select * exclude ({gone}) from {name} qualify row_number() over (partition by {', '.join(KEPT_BY[name])} order by {order}) = 1)"


_WITH = "with " + ",\n".join(_dimension(n) for n in KEPT_BY)
_PLAYER_TEAM = "left join d_players p on {a}.player_id = p.player_id left join d_teams t on {a}.league = t.league and {a}.season = t.season and {a}.team_id = t.team_id"

INT_PLAYER_GAMES = f"""select pg.league, pg.season, pg.game_id, g.season_type, g.week as week, coalesce(g.date, pg.date) as date, pg.team_id, coalesce(t.team_name, pg.team_name) as team_name,
  case when lower(trim(pg.team_name)) = lower(trim(g.home_team_name)) then 'home' when lower(trim(pg.team_name)) = lower(trim(g.visitor_team_name)) then 'away' end as game_location,
  case when lower(trim(pg.team_name)) = lower(trim(g.home_team_name)) then g.visitor_team_name when lower(trim(pg.team_name)) = lower(trim(g.visitor_team_name)) then g.home_team_name end as opponent_team_name,
  g.home_team_name, g.visitor_team_name, pg.source_player_id, pg.player_id, coalesce(p.player_name, pg.player_name) as player_name, p.player_id is not null as has_canonical_player,
  pg.week as week_1, pg.* exclude (loaded_at, league, season, game_id, date, week, team_id, team_name, source_player_id, player_id, player_name)
from player_game_stats pg left join d_games g on pg.league = g.league and pg.season = g.season and pg.game_id = g.game_id {_PLAYER_TEAM.format(a='pg')}"""

INT_PLAYER_SEASONS = f"""select ps.league, ps.season, ps.team_id, coalesce(t.team_name, ps.team_name) as team_name, ps.player_id, coalesce(p.player_name, ps.player_name) as player_name,
  p.player_id is not null as has_canonical_player, ps.* exclude (loaded_at, league, season, team_id, team_name, player_id, player_name)
from player_season_stats ps {_PLAYER_TEAM.format(a='ps')}"""

INT_ROSTERS = f"""select r.league, r.season, r.team_id, coalesce(t.team_name, r.team_name) as team_name, r.player_id, p.player_name as canonical_player_name,
  p.player_id is not null as has_canonical_player, r.* exclude (league, season, team_id, team_name, player_id) from d_rosters r {_PLAYER_TEAM.format(a='r')}"""

INT_TEAM_GAMES = " union all by name ".join(
    f"select league, season, game_id, season_type, week, date, {mine} as team_name, {other} as opponent_team_name, '{side}' as game_location, home_team_name, visitor_team_name, "
    "* exclude (league, season, game_id, season_type, week, date, home_team_name, visitor_team_name) from d_games"
    for side, mine, other in (("home", "home_team_name", "visitor_team_name"), ("away", "visitor_team_name", "home_team_name"))
)

INT_TEAM_SEASONS = """select ts.league, ts.season, ts.team_id, coalesce(t.team_name, ts.team_name) as team_name, s.wins, s.losses, s.ties, s.win_pct,
  ts.* exclude (loaded_at, league, season, team_id, team_name), s.team_logo as team_logo_1,
  s.* exclude (league, season, team_name, wins, losses, ties, win_pct, team_logo, loaded_at)
from team_season_stats ts left join d_teams t on ts.league = t.league and ts.season = t.season and ts.team_id = t.team_id
left join standings s on ts.league = s.league and ts.season = s.season and lower(trim(ts.team_name)) = lower(trim(s.team_name))"""

SEASON_STATS = f"""select ps.*, gc.games_with_stats from ({INT_PLAYER_SEASONS}) ps left join
  (select league, season, team_id, player_id, count(distinct game_id) as games_with_stats from player_game_stats where player_id is not null group by all) gc
  on ps.league = gc.league and ps.season = gc.season and ps.team_id = gc.team_id and ps.player_id = gc.player_id"""


def _ratio(n: str, d: str, factor: float) -> str:
    return f"case when {d} > 0 then cast({n} as double) / cast({d} as double)" + (f" * {factor}" if factor != 1.0 else "") + " end"


def _term(inner: str) -> str:
    return f"least(greatest({inner}, 0.0), 2.375)"


_RATING = " + ".join(
    _term(t) for t in ("(passing_completions / passing_attempts - 0.3) * 5.0", "(passing_yards / passing_attempts - 3.0) * 0.25", "pass_tds / passing_attempts * 20.0", "2.375 - passing_interceptions / passing_attempts * 25.0")
)
QB = f"""select * exclude (pass_tds, completion_pct, passing_average, passer_rating), pass_tds as passing_tds,
  completion_pct as source_completion_pct, passing_average as source_passing_average, passer_rating as source_passer_rating,
  {_ratio('passing_completions', 'passing_attempts', 100.0)} as completion_pct_calculated, {_ratio('passing_yards', 'passing_attempts', 1.0)} as yards_per_attempt,
  {_ratio('pass_tds', 'passing_attempts', 100.0)} as touchdown_pct, {_ratio('passing_interceptions', 'passing_attempts', 100.0)} as interception_pct,
  ({_RATING}) / 6.0 * 100.0 as passer_rating_calculated from ({SEASON_STATS}) where coalesce(passing_attempts, 0) > 0"""

CAREER = f"""select *, {', '.join(f"{_ratio(n, d, f)} as {name}" for name, (n, d, f) in CAREER_RATIOS.items())} from (
  select league, player_id, min(player_name) as player_name, min(season) as first_season, max(season) as last_season, count(distinct season) as seasons_played, count(distinct team_id) as teams_played_for,
  {', '.join(f"cast(sum(coalesce({c}, 0)) as {'bigint' if c == 'games_with_stats' else 'double'}) as {name}" for c, name in CAREER_SUMS.items())}
  from ({SEASON_STATS}) where player_id is not null group by league, player_id)"""

SUMMARY = f"""select ts.*, g.games_scheduled from ({INT_TEAM_SEASONS}) ts left join
  (select league, season, team_name, count(distinct game_id) as games_scheduled from ({INT_TEAM_GAMES}) group by all) g
  on ts.league = g.league and ts.season = g.season and lower(trim(ts.team_name)) = lower(trim(g.team_name))"""

_MARTS = {
    "mart_players": f"select * exclude (canonical_player_name), canonical_player_name as player_name from ({INT_ROSTERS})",
    "mart_player_game_logs": INT_PLAYER_GAMES,
    "mart_player_season_stats": SEASON_STATS,
    "mart_qb_season_stats": QB,
    "mart_player_career_stats": CAREER,
    "mart_team_season_summary": SUMMARY,
}
_LOADED = {name: ["loaded_at", "deleted_at"] if name in ("teams", "players", "games") else ["loaded_at"] for name in STAGED}
_DUCK = {"bigint": "bigint", "string": "varchar", "date": "date", "double": "double"}

SQL: dict[str, str] = (
    {f"stg_{name}": f"select {', '.join(f'cast({c} as {_DUCK[t]}) as {c}' for c, t in head.items())}, * exclude ({', '.join([*head, *_LOADED[name]])}) from {name}" for name, head in STAGED.items()}
    | {name: f"{_WITH} {sql}" for name, sql in zip(INTERMEDIATE, (INT_PLAYER_GAMES, INT_PLAYER_SEASONS, INT_ROSTERS, INT_TEAM_GAMES, INT_TEAM_SEASONS))}
    | {name: f"{_WITH} {sql}" for name, sql in _MARTS.items()}
    | {name.replace("mart_", f"mart_{league}_", 1): f"{_WITH} select * from ({sql}) where league = '{league}'" for league in LEAGUES for name, sql in _MARTS.items()}
)
