"""From landed documents to the eight canonical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.documents import flatten_documents
from ..functions.text import name_key, safe_number, strip_blanks
from ..operators.relational import attach_id, distinct_rows, keep_first, last_non_null, propagate_id, unique_mapping
from ..session import materialise

# What stays text in the statistics; all other columns become doubles.
GAME_TEXT = ("league", "game_id", "date", "team_id", "team_name", "opponent_id", "opponent_name", "home_away", "player_id", "source_player_id", "player_name", "roster_number")
SEASON_TEXT = ("league", "player_id", "player_name", "team_city", "team_name", "team_id")
ORDER = ["league", "season", "file", "pos"]
# The order in which the files of a season are merged.
CATEGORY_ORDER = ("offensive_stats", "defensive_stats", "scoring_stats", "special_teams_stats")


def game_date(date: Column, season: Column) -> Column:
    """2023-05-01, or May 1 and Sep 7 with the season's year."""
    day = F.regexp_replace(strip_blanks(date), r"\s+", " ")
    dated = F.concat(season.cast("string"), F.lit(" "), day)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("date") for t, f in ((day, "yyyy-MM-dd"), (dated, "yyyy MMMM d"), (dated, "yyyy MMM d"))])


def team_place(df: DataFrame) -> DataFrame:
    """Tier, conference and division from conf and div, which the leagues use differently."""
    def is_tier(c: str) -> Column:
        return F.coalesce((F.upper(c) == "WFA PRO") | F.upper(c).startswith("DIV "), F.lit(False))

    wfa, wnfc = F.col("league") == "wfa", F.col("league") == "wnfc"
    none = F.lit(None).cast("string")
    by_conf, by_div = wfa & is_tier("conf"), wfa & ~is_tier("conf") & is_tier("div")
    return df.select(
        *[c for c in df.columns if c not in ("conf", "div", "region")],
        F.when(by_conf, F.col("conf")).when(by_div, F.col("div")).otherwise(none).alias("tier"),
        F.when(wnfc, none).when(by_conf, F.col("div")).otherwise(F.col("conf")).alias("conference"),
        F.when(by_conf | by_div, none).otherwise(F.col("div")).alias("division"),
        "region",
    )


def _with(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``df`` with the named columns, null texts where it lacked them."""
    return df.withColumns({c: F.lit(None).cast("string") for c in names if c not in df.columns})


class Canonical:
    """The canonical tables of a set of documents (league, season, endpoint, resource_id, file, text)."""

    def __init__(self, docs: DataFrame):
        # every document is parsed once, whatever number of tables is asked for
        self.flat = materialise(flatten_documents(docs))

    def rows(self, table: str, columns: list[str] | None = None) -> DataFrame:
        """The rows of one table with their order; columns are the keys seen, or those given."""
        own = self.flat.where(F.col("table_name") == table)
        if columns is None:
            # key names are schema: their number doesn't grow with the rows
            keys = own.select(F.explode(F.map_keys("fields")).alias("k")).distinct().limit(10_001).collect()
            if len(keys) > 10_000:
                raise ValueError(f"{table} has more than 10,000 different keys")
            columns = sorted(r["k"] for r in keys if r["k"] not in ("league", "season", "file", "pos", "endpoint"))
        return own.select("league", "season", "endpoint", "file", "pos", *[F.col("fields")[c].alias(c) for c in columns])

    def _typed(self, df: DataFrame, whole: tuple[str, ...] = (), doubles: tuple[str, ...] = ()) -> DataFrame:
        kinds = {**dict.fromkeys(whole, "bigint"), **dict.fromkeys(doubles, "double")}
        return df.select(*[safe_number(F.col(f"`{c}`"), kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])

    def teams(self) -> DataFrame:
        columns = ["team_id", "team_number", "team_city", "team_name", "conf", "div", "region"]
        return team_place(keep_first(self.rows("teams", columns), ["league", "season", "team_id"], ORDER)).drop("endpoint", "file", "pos")

    def rosters(self) -> DataFrame:
        columns = ["team_id", "team_name", "player_id", "roster_number", "position"]
        return keep_first(self.rows("rosters", columns), ["league", "season", "team_id", "player_id"], ORDER).drop("endpoint", "file", "pos")

    def players(self) -> DataFrame:
        columns = ["player_id", "player_name", "height", "weight", "school", "hometown"]
        return keep_first(self.rows("players", columns), ["player_id"], ORDER).select(*columns)

    def games(self) -> DataFrame:
        columns = ["game_id", "season_type", "week", "date", "visitor_team_name", "visitor_score", "home_team_name", "home_score"]
        typed = self._typed(self.rows("games", columns), ("week", "visitor_score", "home_score")).withColumn("date", game_date(F.col("date"), F.col("season")))
        return keep_first(typed, ["league", "season", "game_id"], ORDER).drop("endpoint", "file", "pos")

    def _name_lookup(self) -> DataFrame:
        """(league, season, team_id, name_key, player_id) of names that one player of the roster bears."""
        named = self.rosters().select("league", "season", "team_id", "player_id").join(self.players().select("player_id", name_key("player_name").alias("name_key")), "player_id", "left").where("name_key <> ''")
        return unique_mapping(named, ["league", "season", "team_id", "name_key"], "player_id")

    def _statistics(self, df: DataFrame, texts: tuple[str, ...]) -> DataFrame:
        kept = (*texts, "season", "week", "endpoint", "file", "pos")
        return self._typed(df, ("week",) if "week" in df.columns else (), tuple(c for c in df.columns if c not in kept))

    def player_game_stats(self) -> DataFrame:
        """Lines of players in games; player_id by the roster's unique name, then by the source id of lines so resolved."""
        lines = _with(self._statistics(self.rows("player_game_stats"), GAME_TEXT), GAME_TEXT)
        lines = lines.withColumn("date", game_date(F.col("date"), F.col("season"))).drop("endpoint", "file", "pos")
        lines = distinct_rows(lines)
        keyed = lines.withColumn("name_key", name_key("player_name"))
        named = attach_id(keyed, self._name_lookup(), ["league", "season", "team_id", "name_key"], "player_id").drop("name_key")
        return propagate_id(materialise(named), ["league", "season", "source_player_id"], "player_id")

    def team_season_stats(self) -> DataFrame:
        stats = self._statistics(self.rows("team_season_stats"), (*SEASON_TEXT, "team_logo", "team_number")).drop("endpoint", "file", "pos")
        lookup = self.teams().select("league", "season", "team_city", "team_name", "team_id").groupBy("league", "season", "team_city", "team_name").agg(F.min("team_id").alias("team_id"))
        return attach_id(_with(stats, ("team_city", "team_name", "team_id")), lookup, ["league", "season", "team_city", "team_name"], "team_id")

    def player_season_stats(self) -> DataFrame:
        """One row per player and season: of each field the last value given, offence first, special teams last."""
        raw = self.rows("player_season_stats")
        rank = F.array_position(F.array(*[F.lit(c) for c in CATEGORY_ORDER]), F.col("endpoint"))
        key = ["league", "season", "team_city", "team_name", "player_name"]
        raw = _with(raw, ("team_city", "team_name", "player_name", "team_id", "player_id"))
        fields = [c for c in raw.columns if c not in (*key, "endpoint", "file", "pos")]
        merged = self._statistics(last_non_null(raw.withColumn("rank", rank), key, fields, ["rank", "file", "pos"]), SEASON_TEXT)
        alias = self.teams().select("league", "season", strip_blanks("team_city").alias("city_key"), strip_blanks("team_name").alias("team_key"), "team_id").groupBy("league", "season", "city_key", "team_key").agg(F.min("team_id").alias("team_id"))
        keyed = merged.withColumns({"city_key": strip_blanks("team_city"), "team_key": strip_blanks("team_name"), "name_key": name_key("player_name")})
        with_team = attach_id(keyed, alias, ["league", "season", "city_key", "team_key"], "team_id")
        return attach_id(with_team, self._name_lookup(), ["league", "season", "team_id", "name_key"], "player_id").drop("city_key", "team_key", "name_key")

    def standings(self) -> DataFrame:
        return self._typed(self.rows("standings", ["tier", "conference", "division", "region", "team_name", "team_logo", "wins", "losses", "ties", "win_pct", "points_for", "points_against", "home_record", "away_record", "conference_record", "division_record", "nonconference_record", "nondivision_record", "streak"]), ("wins", "losses", "ties", "points_for", "points_against"), ("win_pct",)).drop("endpoint", "file", "pos")

    def tables(self) -> dict[str, DataFrame]:
        names = ("teams", "players", "rosters", "games", "player_game_stats", "player_season_stats", "team_season_stats", "standings")
        return {name: getattr(self, name)() for name in names}
