"""Data-quality rules, contracts and the findings they give.

Rules are data: a table of what must hold. All column tests of a table are
taken in one aggregate over one scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .relational import anti_missing, duplicate_groups, one_of, outside

FINDING = "level string, table_name string, check_name string, message string, count long"

# The statistics of players that count something.
_STATS = [
    "rushing_carries", "rushing_tds", "passing_attempts", "passing_completions", "passing_tds", "passing_interceptions",
    "receiving_catches", "receiving_tds", "tackles", "tackle_assists", "tackles_combined", "sacks",
    "tackles_for_loss", "interceptions", "interception_return_tds", "passes_deflected", "fumble_recoveries", "fumble_recovery_tds",
    "forced_fumbles", "kickoff_returns", "kickoff_return_tds", "punt_returns", "punt_return_tds", "fg_attempts",
    "fg_made", "pat_attempts", "pat_made", "punts", "punt_touchbacks",
]

# Columns in which a negative number is wrong (yards may be negative).
NON_NEGATIVE = {
    "games": ["visitor_score", "home_score"],
    "player_game_stats": [*_STATS, "scoring_tds", "scoring_pat1", "scoring_pat2", "scoring_fg", "scoring_safety", "kick_blocks"],
    "player_season_stats": [*_STATS, "blocked_kicks", "total_points", "tds", "two_point_conversions", "safety"],
    "team_season_stats": ["total_points", "points_per_game", "first_downs", "first_downs_per_game", "total_points_allowed", "points_allowed_per_game", "penalties", "penalties_per_game"],
    "standings": ["wins", "losses", "ties", "points_for", "points_against", "win_pct"],
}

# Columns without which a table is unusable.
REQUIRED = {
    "teams": ["league", "season", "team_id", "team_name"],
    "players": ["player_id", "player_name"],
    "rosters": ["league", "season", "team_id", "team_name", "player_id"],
    "games": ["league", "season", "game_id", "season_type", "week", "visitor_team_name", "home_team_name"],
    "player_game_stats": ["league", "season", "game_id", "team_id", "team_name", "source_player_id", "player_id", "player_name"],
    "player_season_stats": ["league", "season", "team_id", "player_id", "player_name", "team_name"],
    "team_season_stats": ["league", "season", "team_id", "team_name"],
    "standings": ["league", "season", "team_name", "wins", "losses", "ties", "win_pct"],
}


@dataclass(frozen=True)
class Unique:
    """A key that no two rows share, among the rows ``where`` holds for."""

    keys: tuple[str, ...]
    level: str = "ERROR"
    where: str = "true"


@dataclass(frozen=True)
class ForeignKey:
    keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]
    level: str = "ERROR"
    allow_null: bool = False


@dataclass(frozen=True)
class Rules:
    unique: tuple[Unique, ...] = ()
    not_null: tuple[str, ...] = ()
    # (column, low, high, level)
    ranges: tuple[tuple[str, float, float, str], ...] = ()
    # (name, condition that marks a wrong row, or how many things are wrong in it, level)
    rows: tuple[tuple[str, str, str], ...] = ()
    # (name, condition, level): told with the share of rows it holds for
    shares: tuple[tuple[str, str, str], ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    foreign: tuple[ForeignKey, ...] = ()
    # (column, values one expects to see, level): a value no row has is told
    coverage: tuple[tuple[str, tuple[str, ...], str], ...] = ()


_TEAM = ("league", "season", "team_id")
RULES = {
    "teams": Rules((Unique(_TEAM),), (*_TEAM, "team_name")),
    "players": Rules((Unique(("player_id",)),), ("player_id", "player_name")),
    "rosters": Rules((Unique((*_TEAM, "player_id")),), (*_TEAM, "player_id"), foreign=(ForeignKey(_TEAM, "teams", _TEAM), ForeignKey(("player_id",), "players", ("player_id",)))),
    "games": Rules(
        (Unique(("league", "season", "game_id")),), ("league", "season", "game_id", "home_team_name", "visitor_team_name"),
        rows=(("home_is_visitor", "home_team_name = visitor_team_name", "ERROR"), ("missing_scores", "cast(home_score is null as int) + cast(visitor_score is null as int)", "INFO")),
    ),
    "player_game_stats": Rules(
        (
            Unique(("league", "season", "game_id", "team_id", "player_id"), "WARNING", "player_id is not null"),
            Unique(("league", "season", "game_id", "team_id", "source_player_id"), "WARNING", "player_id is null and source_player_id is not null"),
        ),
        rows=(("unresolved_player", "player_id is null", "WARNING"),), shares=(("unresolved_player", "player_id is null", "WARNING"),),
        foreign=(ForeignKey(_TEAM, "teams", _TEAM), ForeignKey(("league", "season", "game_id"), "games", ("league", "season", "game_id")), ForeignKey(("player_id",), "players", ("player_id",), allow_null=True)),
    ),
    "player_season_stats": Rules(
        (Unique((*_TEAM, "player_id"), "WARNING", "team_id is not null and player_id is not null"),), ranges=(("completion_pct", 0, 100, "WARNING"),),
        rows=(("unresolved_player", "player_id is null", "WARNING"), ("unresolved_team", "team_id is null", "WARNING")),
        foreign=(ForeignKey(_TEAM, "teams", _TEAM, allow_null=True), ForeignKey(("player_id",), "players", ("player_id",), allow_null=True)),
    ),
    "team_season_stats": Rules((Unique(_TEAM, "WARNING", "team_id is not null"),), rows=(("unresolved_team", "team_id is null", "WARNING"),), foreign=(ForeignKey(_TEAM, "teams", _TEAM, allow_null=True),)),
    "standings": Rules(ranges=(("win_pct", 0, 1, "ERROR"),), coverage=(("league", ("wnfc",), "INFO"),)),
}

LEAGUES = {"league": ("wfa", "wnfc")}
MART_RULES = {
    "mart_players": Rules(not_null=("league", "season", "team_id", "team_name", "player_id"), accepted=LEAGUES),
    "mart_player_game_logs": Rules(not_null=("league", "season", "game_id", "team_id"), accepted=LEAGUES),
    "mart_player_season_stats": Rules(not_null=("league", "season"), accepted=LEAGUES),
    "mart_qb_season_stats": Rules(not_null=("league", "season", "passing_attempts"), accepted=LEAGUES),
    "mart_player_career_stats": Rules(not_null=("league", "player_id"), accepted=LEAGUES),
    "mart_team_season_summary": Rules(not_null=("league", "season"), accepted=LEAGUES),
}


def _one_row(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, FINDING)


def check_table(name: str, df: DataFrame, rules: Rules | None = None, tables: dict[str, DataFrame] | None = None, required: list[str] | None = None) -> DataFrame:
    """Findings (level, table_name, check_name, message, count) of one table; a rule on a column the table lacks is passed over.

    Missing required columns are findings themselves. Duplicate keys count as
    groups, foreign keys as different keys. Nulls are out of no range. An empty
    table breaks no rule, but lacks the values that ``coverage`` asks for.
    """
    rules = rules or RULES.get(name, Rules())
    spark, have = df.sparkSession, set(df.columns)
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    tests: list[tuple[str, str, str, object]] = []
    for c in rules.not_null:
        tests.append(("ERROR", "not_null", c, F.count_if(F.col(c).isNull())))
    for c in NON_NEGATIVE.get(name, []):
        if c in numeric:
            tests.append(("WARNING", "non_negative", c, F.count_if(F.col(c) < 0)))
    for c, low, high, level in rules.ranges:
        tests.append((level, "range", c, F.count_if(outside(c, low, high))))
    for label, wrong, level in rules.rows:
        tests.append((level, "rows", label, F.coalesce(F.sum(F.expr(f"cast({wrong} as int)")), F.lit(0))))
    for label, wrong, level in rules.shares:
        tests.append((level, "share", label, F.count_if(F.expr(wrong))))
    for c, values in rules.accepted.items():
        tests.append(("ERROR", "accepted_values", c, F.count_if(F.col(c).isNotNull() & ~one_of(c, values))))
    for c, values, level in rules.coverage:
        tests += [(level, "coverage", f"{c}: no {v}", F.when(F.count_if(F.col(c) == v) == 0, 1).otherwise(0)) for v in values if c in have]
    possible = [t for t in tests if t[1] in ("rows", "share", "coverage") or t[2] in have]
    found = []
    lacking = sorted(set(required if required is not None else REQUIRED.get(name, [])) - have)
    if lacking:
        found.append(_one_row(spark, [("ERROR", name, "required_columns", f"missing: {', '.join(lacking)}", len(lacking))]))
    if possible:
        one = df.agg(F.count("*").alias("rows"), *[e.alias(f"t{n}") for n, (_, _, _, e) in enumerate(possible)])

        def cell(n: int, level: str, kind: str, what: str) -> Column:
            share = F.format_string(f"{what}: %.2f %% of the rows", F.try_divide(100.0 * F.col(f"t{n}"), F.col("rows")))
            return F.struct(F.lit(level).alias("level"), F.lit(name).alias("table_name"), F.lit(kind).alias("check_name"), (share if kind == "share" else F.lit(what)).alias("message"), F.col(f"t{n}").cast("long").alias("count"))

        cells = F.array(*[cell(n, *t[:3]) for n, t in enumerate(possible)])
        found.append(one.select(F.explode(cells).alias("f")).select("f.*").where("count > 0"))
    for u in rules.unique:
        if set(u.keys) <= have:
            n = duplicate_groups(df.where(u.where), list(u.keys)).agg(F.count("*").alias("count")).where("count > 0")
            found.append(n.select(F.lit(u.level).alias("level"), F.lit(name).alias("table_name"), F.lit("unique").alias("check_name"), F.lit(", ".join(u.keys)).alias("message"), "count"))
    for k in rules.foreign:
        if tables and k.parent in tables and set(k.keys) <= have:
            n = anti_missing(df, tables[k.parent], list(k.keys), list(k.parent_keys), k.allow_null).agg(F.count("*").alias("count")).where("count > 0")
            found.append(n.select(F.lit(k.level).alias("level"), F.lit(name).alias("table_name"), F.lit("foreign_key").alias("check_name"), F.lit(f"{', '.join(k.keys)} -> {k.parent}").alias("message"), "count"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], FINDING)


def check_all(tables: dict[str, DataFrame], expected: tuple[str, ...] = ()) -> DataFrame:
    """The findings of all tables; a table of ``expected`` that isn't there is a finding itself."""
    found = [check_table(name, df, tables=tables) for name, df in tables.items()]
    lacking = [name for name in expected if name not in tables]
    if lacking:
        found.append(_one_row(SparkSession.getActiveSession(), [("ERROR", name, "table_exists", "the table is missing", 1) for name in lacking]))
    return reduce(DataFrame.unionByName, found)


def check_marts(marts: dict[str, DataFrame]) -> DataFrame:
    """The findings of the core marts: nulls where there must be none, leagues that are none."""
    return reduce(DataFrame.unionByName, [check_table(name, df, MART_RULES[name], required=[]) for name, df in marts.items()])


def in_order(findings: DataFrame) -> DataFrame:
    """ERROR before WARNING before INFO, then by table and check."""
    rank = F.when(F.col("level") == "ERROR", 0).when(F.col("level") == "WARNING", 1).otherwise(2)
    return findings.orderBy(rank, "table_name", "check_name", "message")


@dataclass(frozen=True)
class Contract:
    """What a released table must look like. ``lenient`` tables may hold repeated and null keys."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    partition: tuple[str, ...] = ("league", "season")
    lenient: bool = False
    description: str = ""
    grain: str = ""

    def schema(self) -> T.StructType:
        kinds = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "date": T.DateType()}
        return T.StructType([T.StructField(c, kinds[k]) for c, k in self.columns.items()])

    def problems(self, df: DataFrame) -> list[str]:
        """Missing columns, columns of another type, and repeated keys; any integer type does for a long."""
        out = [f"{self.name}: column {c} is missing" for c in self.columns if c not in df.columns]
        for want in self.schema():
            if want.name in df.columns and not same_type(df.schema[want.name].dataType, want.dataType):
                out.append(f"{self.name}: column {want.name} is {df.schema[want.name].dataType.simpleString()}, not {want.dataType.simpleString()}")
        if not out and not self.lenient and (n := key_problems(self, df)):
            out.append(f"{self.name}: {n} duplicate keys ({', '.join(self.key)})")
        return out


def key_problems(contract: Contract, df: DataFrame) -> int:
    """How many keys several rows have; in lenient tables only among rows that give the whole key."""
    given = df.dropna(subset=list(contract.key)) if contract.lenient else df
    return duplicate_groups(given, list(contract.key)).count()


def same_type(a: T.DataType, b: T.DataType) -> bool:
    return a == b or isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)


CONTRACT_VERSION = "2.0.0"

# The columns a released table must have with their types, its key, and whether repeated keys are refused or counted.
CONTRACTS = {
    "teams": Contract(
        "teams", {"league": "string", "season": "long", "team_id": "string", "team_name": "string"}, ("league", "season", "team_id"),
        description="The teams of each league and season and where they stand in it.", grain="One row for each team of a league's season.",
    ),
    "players": Contract(
        "players", {"player_id": "string", "player_name": "string"}, ("player_id",), (),
        description="The players that rosters name.", grain="One row for each player.",
    ),
    "rosters": Contract(
        "rosters", {"league": "string", "season": "long", "team_id": "string", "player_id": "string", "team_name": "string"}, ("league", "season", "team_id", "player_id"),
        description="Which player is on which team.", grain="One row for each player on a team in a league's season.",
    ),
    "games": Contract(
        "games",
        {"league": "string", "season": "long", "game_id": "string", "season_type": "string", "week": "long", "date": "date", "visitor_team_name": "string", "home_team_name": "string"},
        ("league", "season", "game_id"),
        description="The schedule with its results.", grain="One row for each game of a league's season.",
    ),
    "player_game_stats": Contract(
        "player_game_stats",
        {
            "league": "string", "season": "long", "game_id": "string", "team_id": "string", "player_id": "string",
            "date": "date", "team_name": "string", "source_player_id": "string", "player_name": "string",
        },
        ("league", "season", "game_id", "team_id", "player_id"), lenient=True,
        description="What each player did in each game.", grain="One row for each player in a game, where the source has no repeats.",
    ),
    "player_season_stats": Contract(
        "player_season_stats",
        {"league": "string", "season": "long", "team_id": "string", "player_id": "string", "player_name": "string", "team_name": "string"},
        ("league", "season", "team_id", "player_id"), lenient=True,
        description="What each player did in each season.", grain="One row for each player on a team in a season, where the source has no repeats.",
    ),
    "team_season_stats": Contract(
        "team_season_stats", {"league": "string", "season": "long", "team_id": "string", "team_name": "string"}, ("league", "season", "team_id"), lenient=True,
        description="What each team did in each season.", grain="One row for each team of a season, where the source has no repeats.",
    ),
    "standings": Contract(
        "standings", {"league": "string", "season": "long", "team_name": "string", "wins": "long", "losses": "long", "ties": "long", "win_pct": "double"}, ("league", "season", "team_name"),
        description="Where each team ended up.", grain="One row for each team of a league's season.",
    ),
}


def contract_of(name: str) -> Contract:
    if name not in CONTRACTS:
        raise KeyError(f"no contract for {name}; there are {', '.join(sorted(CONTRACTS))}")
    return CONTRACTS[name]


def enforce(tables: dict[str, DataFrame]) -> None:
    """Raises once, with all problems of all tables."""
    problems = [p for name, df in tables.items() for p in contract_of(name).problems(df)]
    if problems:
        raise ValueError("; ".join(problems))
