"""Staging, intermediate and mart layers over the canonical tables.

Every model is a function from frames to a frame: Catalyst sees one plan from
the Parquet scan to the mart. Dimension tables are joined plainly, so Spark
broadcasts them while their measured size allows and shuffles beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import guarded_ratio, passer_rating
from ..operators.relational import constant_view, distinct_counts, enrich, head_and_rest, keep_first, sides
from ..sources.tables import table

# The typed head of each staging model; the other columns follow as they are.
STAGED = {
    "games": {"league": "string", "season": "bigint", "game_id": "string", "season_type": "string", "week": "bigint", "date": "date", "visitor_team_name": "string", "home_team_name": "string"},
    "player_game_stats": {"league": "string", "season": "bigint", "game_id": "string", "date": "date", "team_id": "string", "team_name": "string", "source_player_id": "string", "player_id": "string", "player_name": "string"},
    "player_season_stats": {"league": "string", "season": "bigint", "team_id": "string", "player_id": "string", "player_name": "string", "team_name": "string"},
    "players": {"player_id": "string", "player_name": "string"},
    "rosters": {"league": "string", "season": "bigint", "team_id": "string", "team_name": "string", "player_id": "string"},
    "standings": {"league": "string", "season": "bigint", "team_name": "string", "wins": "bigint", "losses": "bigint", "ties": "bigint", "win_pct": "double"},
    "team_season_stats": {"league": "string", "season": "bigint", "team_id": "string", "team_name": "string"},
    "teams": {"league": "string", "season": "bigint", "team_id": "string", "team_name": "string"},
}

# The key by which the first row of a canonical table is kept.
KEPT_BY = {
    "teams": ["league", "season", "team_id"],
    "rosters": ["league", "season", "team_id", "player_id"],
    "players": ["player_id"],
    "games": ["league", "season", "game_id"],
}

# What a career sums, under which name.
CAREER_SUMS = {
    "games_with_stats": "games_with_stats",
    "passing_attempts": "passing_attempts", "passing_completions": "passing_completions", "passing_yards": "passing_yards",
    "pass_tds": "passing_tds", "passing_interceptions": "passing_interceptions",
    "rushing_carries": "rushing_carries", "rushing_yards": "rushing_yards",
    "receiving_catches": "receiving_catches", "receiving_yards": "receiving_yards", "receiving_tds": "receiving_tds",
    "tackles": "tackles", "tackle_assists": "tackle_assists", "tackles_combined": "tackles_combined", "tackles_for_loss": "tackles_for_loss",
    "sacks": "sacks", "interceptions": "defensive_interceptions", "forced_fumbles": "forced_fumbles", "fumble_recoveries": "fumble_recoveries",
    "passes_deflected": "passes_deflected", "blocked_kicks": "blocked_kicks",
    "kickoff_returns": "kickoff_returns", "kickoff_return_yards": "kickoff_return_yards", "kickoff_return_tds": "kickoff_return_tds",
    "punt_returns": "punt_returns", "punt_return_yards": "punt_return_yards", "punt_return_tds": "punt_return_tds",
    "interception_return_yards": "interception_return_yards", "interception_return_tds": "interception_return_tds",
    "fumble_recovery_yards": "fumble_recovery_yards", "fumble_recovery_tds": "fumble_recovery_tds",
    "fg_made": "field_goals_made", "fg_attempts": "field_goal_attempts", "pat_made": "pats_made", "pat_attempts": "pat_attempts",
    "punts": "punts", "punt_yards": "punt_yards", "tds": "total_tds", "two_point_conversions": "two_point_conversions",
    "safety": "safeties", "total_points": "total_points",
}

# The ratios of a career: numerator, denominator, factor.
CAREER_RATIOS = {
    "career_completion_pct": ("passing_completions", "passing_attempts", 100.0),
    "career_yards_per_attempt": ("passing_yards", "passing_attempts", 1.0),
    "career_yards_per_carry": ("rushing_yards", "rushing_carries", 1.0),
    "career_yards_per_reception": ("receiving_yards", "receiving_catches", 1.0),
    "career_kickoff_return_average": ("kickoff_return_yards", "kickoff_returns", 1.0),
    "career_punt_return_average": ("punt_return_yards", "punt_returns", 1.0),
    "career_punt_average": ("punt_yards", "punts", 1.0),
    "career_field_goal_pct": ("field_goals_made", "field_goal_attempts", 100.0),
    "career_pat_pct": ("pats_made", "pat_attempts", 100.0),
}

# The statistics that the passers' mart takes from the source beside the sums.
QB_SOURCE = ("passing_long", "completion_pct", "passing_average", "passer_rating")

LEAGUES = ("wfa", "wnfc")


_SCOPE = [("league", "league"), ("season", "season")]


class Models:
    """The models over a set of canonical tables given by name."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = dict(tables)
        # statistics that no document of a release names are null, so that its marts have the same columns as any other's
        if (seasons := tables.get("player_season_stats")) is not None:
            needed = [c for c in (*CAREER_SUMS, *QB_SOURCE) if c != "games_with_stats" and c not in seasons.columns]
            self.tables["player_season_stats"] = seasons.withColumns({c: F.lit(None).cast("double") for c in needed})

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Models:
        """Over a table directory: dimensions keep the first loaded row of each key, as normalisation leaves them."""
        tables = {}
        for name in STAGED:
            df = table(spark, sf_dir, name)
            kept = keep_first(df, KEPT_BY[name], ["loaded_at"]) if name in KEPT_BY else df
            # when a row reached us orders the rows; it is no part of the canonical tables
            tables[name] = kept.drop("loaded_at", "deleted_at")
        return cls(tables)

    def staging(self, name: str) -> DataFrame:
        head = STAGED[name]
        return head_and_rest(self.tables[name], [F.col(c).cast(t).alias(c) for c, t in head.items()], list(head))

    def _with_dimensions(self, facts: DataFrame) -> DataFrame:
        """Facts with the player and the team they name, as p_ and t_ columns; null keys match nothing."""
        with_player = enrich(facts, self.staging("players").select("player_id", "player_name"), "p_", [("player_id", "player_id")])
        return enrich(with_player, self.staging("teams").select("league", "season", "team_id", "team_name"), "t_", [*_SCOPE, ("team_id", "team_id")])

    def int_player_games(self) -> DataFrame:
        pg = self.staging("player_game_stats")
        g = self.staging("games").select("league", "season", "game_id", "season_type", "week", "date", "home_team_name", "visitor_team_name")
        joined = self._with_dimensions(enrich(pg, g, "g_", [*_SCOPE, ("game_id", "game_id")]))
        team = F.lower(F.trim("team_name"))
        home, away = team == F.lower(F.trim("g_home_team_name")), team == F.lower(F.trim("g_visitor_team_name"))
        head = [
            "league", "season", "game_id", F.col("g_season_type").alias("season_type"), F.col("g_week").alias("week"), F.coalesce("g_date", "date").alias("date"), "team_id",
            F.coalesce("t_team_name", "team_name").alias("team_name"),
            F.when(home, "home").when(away, "away").alias("game_location"),
            F.when(home, F.col("g_visitor_team_name")).when(away, F.col("g_home_team_name")).alias("opponent_team_name"),
            F.col("g_home_team_name").alias("home_team_name"), F.col("g_visitor_team_name").alias("visitor_team_name"),
            "source_player_id", "player_id", F.coalesce("p_player_name", "player_name").alias("player_name"), F.col("p_player_id").isNotNull().alias("has_canonical_player"),
        ]
        gone = ["league", "season", "game_id", "date", "team_id", "team_name", "source_player_id", "player_id", "player_name"]
        return head_and_rest(joined, head, gone, pg.columns)

    def int_player_seasons(self) -> DataFrame:
        ps = self.staging("player_season_stats")
        gone = ["league", "season", "team_id", "team_name", "player_id", "player_name"]
        head = ["league", "season", "team_id", F.coalesce("t_team_name", "team_name").alias("team_name"), "player_id", F.coalesce("p_player_name", "player_name").alias("player_name"), F.col("p_player_id").isNotNull().alias("has_canonical_player")]
        return head_and_rest(self._with_dimensions(ps), head, gone, ps.columns)

    def int_roster_memberships(self) -> DataFrame:
        r = self.staging("rosters")
        head = ["league", "season", "team_id", F.coalesce("t_team_name", "team_name").alias("team_name"), "player_id", F.col("p_player_name").alias("canonical_player_name"), F.col("p_player_id").isNotNull().alias("has_canonical_player")]
        return head_and_rest(self._with_dimensions(r), head, ["league", "season", "team_id", "team_name", "player_id"], r.columns)

    def int_team_games(self) -> DataFrame:
        """Each game twice, seen from either team."""
        g = self.staging("games")
        views = [{"team_name": F.col(mine), "opponent_team_name": F.col(other), "game_location": F.lit(side)} for side, mine, other in (("home", "home_team_name", "visitor_team_name"), ("away", "visitor_team_name", "home_team_name"))]
        head = ["league", "season", "game_id", "season_type", "week", "date", "team_name", "opponent_team_name", "game_location", "home_team_name", "visitor_team_name"]
        return head_and_rest(sides(g, views), head, head)

    def int_team_seasons(self) -> DataFrame:
        ts, st = self.staging("team_season_stats"), self.staging("standings")
        with_team = enrich(ts, self.staging("teams").select("league", "season", "team_id", "team_name"), "t_", [*_SCOPE, ("team_id", "team_id")])
        joined = enrich(with_team, st, "s_", [*_SCOPE, ("team_name", "team_name")], fold=True)
        head = ["league", "season", "team_id", F.coalesce("t_team_name", "team_name").alias("team_name"), *[F.col(f"s_{c}").alias(c) for c in ("wins", "losses", "ties", "win_pct")]]
        hidden = ("league", "season", "team_id", "team_name")
        known = ("league", "season", "team_name", "wins", "losses", "ties", "win_pct")
        # both sides are starred into the result, so a name of both comes out twice, the second suffixed
        rest = [c for c in ts.columns if c not in hidden] + [(f"s_{c}", c) for c in st.columns if c not in known]
        return head_and_rest(joined, head, [], rest)

    def mart_players(self) -> DataFrame:
        r = self.int_roster_memberships()
        head = ["league", "season", "team_id", "team_name", "player_id", F.col("canonical_player_name").alias("player_name"), "has_canonical_player"]
        return head_and_rest(r, head, ["league", "season", "team_id", "team_name", "player_id", "canonical_player_name", "has_canonical_player"])

    def mart_player_game_logs(self) -> DataFrame:
        head = ["league", "season", "season_type", "week", "date", "game_id", "team_id", "team_name", "opponent_team_name", "game_location", "home_team_name", "visitor_team_name", "player_id", "source_player_id", "player_name", "has_canonical_player"]
        return head_and_rest(self.int_player_games(), head, head)

    def mart_player_season_stats(self) -> DataFrame:
        ps = self.int_player_seasons()
        # the counts need four columns of the facts: dimensions play no part, so none is joined for them
        keys = ["league", "season", "team_id", "player_id"]
        counts = distinct_counts(self.staging("player_game_stats").where("player_id is not null"), keys, "game_id", "games_with_stats")
        joined = enrich(ps, counts, "c_", [(k, k) for k in keys])
        first = ["league", "season", "team_id", "team_name", "player_id", "player_name", "has_canonical_player"]
        return head_and_rest(joined, [*first, F.col("c_games_with_stats").alias("games_with_stats")], first, ps.columns)

    def mart_qb_season_stats(self) -> DataFrame:
        q = self.mart_player_season_stats().where(F.coalesce("passing_attempts", F.lit(0)) > 0)
        head = [
            "league", "season", "team_id", "team_name", "player_id", "player_name", "games_with_stats", "passing_attempts", "passing_completions", "passing_yards",
            F.col("pass_tds").alias("passing_tds"), "passing_interceptions", "passing_long",
            F.col("completion_pct").alias("source_completion_pct"), F.col("passing_average").alias("source_passing_average"), F.col("passer_rating").alias("source_passer_rating"),
            guarded_ratio("passing_completions", "passing_attempts", 100.0).alias("completion_pct_calculated"),
            guarded_ratio("passing_yards", "passing_attempts").alias("yards_per_attempt"),
            guarded_ratio("pass_tds", "passing_attempts", 100.0).alias("touchdown_pct"),
            guarded_ratio("passing_interceptions", "passing_attempts", 100.0).alias("interception_pct"),
            passer_rating("passing_attempts", "passing_completions", "passing_yards", "pass_tds", "passing_interceptions").alias("passer_rating_calculated"),
            "has_canonical_player",
        ]
        gone = ["league", "season", "team_id", "team_name", "player_id", "player_name", "games_with_stats", "passing_attempts", "passing_completions", "passing_yards", "pass_tds", "passing_interceptions", "passing_long", "completion_pct", "passing_average", "passer_rating", "has_canonical_player"]
        return head_and_rest(q, head, gone)

    def mart_player_career_stats(self) -> DataFrame:
        """Sums over all seasons; the name is any one of the player's, here the smallest, so that runs agree."""
        ps = self.mart_player_season_stats().where("player_id is not null")
        career = ps.groupBy("league", "player_id").agg(
            F.min("player_name").alias("player_name"), F.min("season").alias("first_season"), F.max("season").alias("last_season"),
            F.count_distinct("season").alias("seasons_played"), F.count_distinct("team_id").alias("teams_played_for"),
            *[F.sum(F.coalesce(c, F.lit(0))).alias(name) for c, name in CAREER_SUMS.items()],
        )
        return career.withColumns({name: guarded_ratio(n, d, f) for name, (n, d, f) in CAREER_RATIOS.items()})

    def mart_team_season_summary(self) -> DataFrame:
        ts = self.int_team_seasons()
        games = distinct_counts(self.int_team_games(), ["league", "season", "team_name"], "game_id", "games_scheduled")
        joined = enrich(ts, games, "g_", [*_SCOPE, ("team_name", "team_name")], fold=True)
        first = ["league", "season", "team_id", "team_name", F.col("g_games_scheduled").alias("games_scheduled"), "wins", "losses", "ties", "win_pct"]
        return head_and_rest(joined, first, ["league", "season", "team_id", "team_name", "wins", "losses", "ties", "win_pct"], ts.columns)

    CORE = ("mart_players", "mart_player_game_logs", "mart_player_season_stats", "mart_qb_season_stats", "mart_player_career_stats", "mart_team_season_summary")

    def core(self, name: str) -> DataFrame:
        if name not in self.CORE:
            raise KeyError(f"unknown mart {name}; known are {', '.join(self.CORE)}")
        return getattr(self, name)()

    def league_view(self, league: str, name: str) -> DataFrame:
        """A core mart of one league; the filter reaches the Parquet scan."""
        return constant_view(self.core(name), "league", league)

    def create_views(self) -> None:
        """Staging, intermediate and league models as views of the session."""
        for name in STAGED:
            self.staging(name).createOrReplaceTempView(f"stg_{name}")
        for name in ("int_player_games", "int_player_seasons", "int_roster_memberships", "int_team_games", "int_team_seasons"):
            getattr(self, name)().createOrReplaceTempView(name)
        for name in self.CORE:
            mart = self.core(name)
            mart.createOrReplaceTempView(name)
            for league in LEAGUES:
                constant_view(mart, "league", league).createOrReplaceTempView(name.replace("mart_", f"mart_{league}_", 1))
