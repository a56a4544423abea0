"""Audit of unresolved identities: what the rosters know about each row that found no player or team.

Indexes are aggregates of the roster joined by key; evidence is counted as
"different candidates under the key" less "those of the row's own team or
season", both pre-aggregated, so no list of candidates is held for a name that
many bear. The candidates themselves come out as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.people import first_initial, normalised_name, surname
from ..functions.text import blank_to_null
from .relational import counted, distinct_joined, union_diagonal


def _context(df: DataFrame, name: str = "player_name") -> DataFrame:
    """The keys of the audit beside the rows: league in lower case, season as text, names exact and normalised."""
    clean = df.withColumns({"_league": F.lower(blank_to_null("league")), "_season": blank_to_null("season"), "_team": blank_to_null("team_id"), "_name": blank_to_null(name)})
    return clean.withColumns({"_exact": F.lower("_name"), "_norm": normalised_name(F.col("_name"))}).withColumns({"_surname": surname(F.col("_norm")), "_initial": first_initial(F.col("_norm"))})


def roster_index(rosters: DataFrame, players: DataFrame) -> DataFrame:
    """(_league, _season, _team, player, player_name, _exact, _norm, _surname, _initial) of each roster member."""
    names = players.select(blank_to_null("player_id").alias("player"), "player_name").where("player is not null").groupBy("player").agg(F.min("player_name").alias("player_name"))
    members = rosters.select("league", "season", "team_id", blank_to_null("player_id").alias("player")).where("player is not null").distinct()
    return _context(members.join(names, "player", "left")).select("_league", "_season", "_team", "player", "player_name", "_exact", "_norm", "_surname", "_initial").where("_league is not null and _season is not null and _team is not null")


def source_links(resolved: DataFrame) -> DataFrame:
    """(_league, _season, _source, n_source, source_player_ids): the players that resolved rows link to each source id."""
    rows = _context(resolved.where("player_id is not null")).withColumn("_source", blank_to_null("source_player_id")).where("_source is not null and _league is not null and _season is not null")
    return rows.groupBy("_league", "_season", "_source").agg(F.count_distinct("player_id").alias("n_source"), distinct_joined("player_id").alias("source_player_ids"))


def _counted(index: DataFrame, keys: list[str], what: list[str], name: str) -> DataFrame:
    given = index.dropna(subset=keys)
    return given.select(*keys, *[w for w in what if w not in keys]).distinct().groupBy(*keys).agg(F.count("*").alias(name))


def diagnosis() -> Column:
    """The first of nine outcomes that holds; needs the counts of ``with_counts``."""
    return (
        F.when(F.col("_league").isNull() | F.col("_season").isNull() | F.col("_team").isNull(), "MISSING_IDENTITY_CONTEXT")
        .when(F.col("roster_rows_for_team_season") == 0, "NO_ROSTER_FOR_TEAM_SEASON")
        .when(F.col("_name").isNull(), "MISSING_PLAYER_NAME")
        .when(F.col("exact_candidate_count") == 1, "EXACT_NAME_UNIQUE_CANDIDATE")
        .when(F.col("exact_candidate_count") > 1, "EXACT_NAME_AMBIGUOUS")
        .when(F.col("_norm").isNull(), "MISSING_NORMALIZED_NAME")
        .when(F.col("normalized_candidate_count") == 1, "NORMALIZED_NAME_UNIQUE_CANDIDATE")
        .when(F.col("normalized_candidate_count") > 1, "NORMALIZED_NAME_AMBIGUOUS")
        .otherwise("NO_PLAYER_CANDIDATE_ON_ROSTER")
    )


# The kinds of evidence in order, with the outcome for one candidate and for several.
EVIDENCE = (
    ("n_source", "SOURCE_PLAYER_ID_UNIQUE_LINK", "SOURCE_PLAYER_ID_AMBIGUOUS_LINK"),
    ("n_same_exact", "POSSIBLE_TEAM_TRANSFER_EXACT_NAME", "SAME_SEASON_EXACT_NAME_MULTIPLE_TEAMS"),
    ("n_same_norm", "POSSIBLE_TEAM_TRANSFER_NORMALIZED_NAME", "SAME_SEASON_NORMALIZED_NAME_MULTIPLE_TEAMS"),
    ("n_other_exact", "PLAYER_EXISTS_OTHER_SEASON_EXACT_NAME", "PLAYER_EXISTS_MULTIPLE_OTHER_SEASONS_EXACT_NAME"),
    ("n_other_norm", "PLAYER_EXISTS_OTHER_SEASON_NORMALIZED_NAME", "PLAYER_EXISTS_MULTIPLE_OTHER_SEASONS_NORMALIZED_NAME"),
    ("n_surname", "POSSIBLE_NAME_VARIANT_SURNAME_INITIAL", "AMBIGUOUS_SURNAME_INITIAL"),
)


def evidence_class() -> Column:
    out = F.lit(None).cast("string")
    for n, (count, one, many) in enumerate(EVIDENCE):
        out = F.when(F.col(count) == 1, one).when(F.col(count) > 1, many) if n == 0 else out.when(F.col(count) == 1, one).when(F.col(count) > 1, many)
    return out.otherwise("NO_CROSS_ROSTER_EVIDENCE")


def disposition(diagnosis: Column, evidence: Column) -> Column:
    """What becomes of a row: the first of eight rules that holds."""
    return (
        F.when(diagnosis == "NO_ROSTER_FOR_TEAM_SEASON", "SOURCE_ROSTER_MISSING")
        .when(diagnosis.isin("EXACT_NAME_AMBIGUOUS", "NORMALIZED_NAME_AMBIGUOUS"), "SOURCE_PLAYER_IDENTITY_AMBIGUOUS")
        .when(diagnosis.isin("MISSING_IDENTITY_CONTEXT", "MISSING_PLAYER_NAME", "MISSING_NORMALIZED_NAME"), "SOURCE_IDENTITY_CONTEXT_MISSING")
        .when(evidence.isin("PLAYER_EXISTS_OTHER_SEASON_EXACT_NAME", "PLAYER_EXISTS_MULTIPLE_OTHER_SEASONS_EXACT_NAME"), "CROSS_SEASON_IDENTITY_ONLY")
        .when(evidence.isin("PLAYER_EXISTS_OTHER_SEASON_NORMALIZED_NAME", "PLAYER_EXISTS_MULTIPLE_OTHER_SEASONS_NORMALIZED_NAME", "POSSIBLE_NAME_VARIANT_SURNAME_INITIAL", "AMBIGUOUS_SURNAME_INITIAL", "POSSIBLE_TEAM_TRANSFER_NORMALIZED_NAME", "SAME_SEASON_NORMALIZED_NAME_MULTIPLE_TEAMS"), "NAME_VARIANT_REVIEW")
        .when(evidence.isin("POSSIBLE_TEAM_TRANSFER_EXACT_NAME", "SAME_SEASON_EXACT_NAME_MULTIPLE_TEAMS"), "SOURCE_PLAYER_IDENTITY_AMBIGUOUS")
        .when((diagnosis == "NO_PLAYER_CANDIDATE_ON_ROSTER") & (evidence == "NO_CROSS_ROSTER_EVIDENCE"), "SOURCE_PLAYER_NOT_ON_ROSTER")
        .otherwise("NO_IDENTITY_EVIDENCE")
    )


def _less_own(df: DataFrame, index: DataFrame, keys: list[str], own: str, what: list[str], name: str) -> DataFrame:
    """Adds the number of candidates under ``keys`` that don't share the row's own team or season."""
    # ``what`` holds ``own``, so the candidates under a key are those of its teams or seasons together
    mine = _counted(index, [*keys, own], what, "_own")
    whole = mine.groupBy(*keys).agg(F.sum("_own").alias("_all"))
    out = df.join(whole, keys, "left").join(mine, [*keys, own], "left")
    return out.withColumn(name, F.coalesce("_all", F.lit(0)) - F.coalesce("_own", F.lit(0))).drop("_all", "_own")


def audit_players(unresolved: DataFrame, rosters: DataFrame, players: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """``unresolved`` rows with diagnosis, evidence class, disposition and the counts they rest on.

    Each input row comes out once, repeated rows included. ``resolved`` rows
    give the links of source ids; without them that evidence is left out.
    Null or blank keys match nothing.
    """
    index = roster_index(rosters, players)
    team, pair = ["_league", "_season", "_team"], ["_team", "player"]
    own = [c for c in unresolved.columns]
    df = _context(unresolved)
    df = df.join(index.groupBy(*team).agg(F.count("*").alias("roster_rows_for_team_season")), team, "left")
    for key, label in (("_exact", "exact"), ("_norm", "normalized")):
        found = index.dropna(subset=[*team, key]).groupBy(*team, key).agg(F.count_distinct("player").alias(f"{label}_candidate_count"), distinct_joined("player").alias(f"{label}_candidate_player_ids"))
        df = df.join(found, [*team, key], "left")
    df = df.fillna(0, ["roster_rows_for_team_season", "exact_candidate_count", "normalized_candidate_count"])
    if resolved is not None and "source_player_id" in own:
        df = df.withColumn("_source", blank_to_null("source_player_id")).join(source_links(resolved), ["_league", "_season", "_source"], "left").fillna(0, ["n_source"]).drop("_source")
    else:
        df = df.withColumns({"n_source": F.lit(0), "source_player_ids": F.lit(None).cast("string")})
    df = _less_own(df, index, ["_league", "_season", "_exact"], "_team", pair, "n_same_exact")
    df = _less_own(df, index, ["_league", "_season", "_norm"], "_team", pair, "n_same_norm")
    df = _less_own(df, index, ["_league", "_exact"], "_season", ["_season", *pair], "n_other_exact")
    df = _less_own(df, index, ["_league", "_norm"], "_season", ["_season", *pair], "n_other_norm")
    df = _less_own(df, index, ["_league", "_season", "_surname", "_initial"], "_team", pair, "n_surname")
    df = df.withColumn("diagnosis", diagnosis()).withColumn("evidence_class", evidence_class())
    df = df.withColumn("disposition", disposition(F.col("diagnosis"), F.col("evidence_class")))
    counts = ["roster_rows_for_team_season", "exact_candidate_count", "exact_candidate_player_ids", "normalized_candidate_count", "normalized_candidate_player_ids", "source_player_ids", *[e[0] for e in EVIDENCE]]
    return df.select(*own, F.col("_norm").alias("normalized_player_name"), "diagnosis", "evidence_class", "disposition", *counts)


def audit_teams(unresolved: DataFrame, teams: DataFrame) -> DataFrame:
    """Team rows without id with the teams that bear their name in that season, exactly or normalised."""
    own = unresolved.columns
    named = _context(teams, "team_name").where("_league is not null and _season is not null and _team is not null")
    df = _context(unresolved, "team_name")
    for key, label in (("_exact", "exact"), ("_norm", "normalized")):
        found = named.dropna(subset=[key]).groupBy("_league", "_season", key).agg(F.count_distinct("_team").alias(f"{label}_candidate_count"), distinct_joined("_team").alias(f"{label}_candidate_team_ids"))
        df = df.join(found, ["_league", "_season", key], "left")
    df = df.fillna(0, ["exact_candidate_count", "normalized_candidate_count"])
    outcome = (
        F.when(F.col("exact_candidate_count") == 1, "EXACT_TEAM_NAME_UNIQUE_CANDIDATE").when(F.col("exact_candidate_count") > 1, "EXACT_TEAM_NAME_AMBIGUOUS")
        .when(F.col("normalized_candidate_count") == 1, "NORMALIZED_TEAM_NAME_UNIQUE_CANDIDATE").when(F.col("normalized_candidate_count") > 1, "NORMALIZED_TEAM_NAME_AMBIGUOUS")
        .otherwise("NO_TEAM_CANDIDATE")
    )
    return df.withColumn("diagnosis", outcome).withColumn("disposition", F.lit("TEAM_SOURCE_UNRESOLVED")).select(*own, "diagnosis", "disposition", "exact_candidate_count", "exact_candidate_team_ids", "normalized_candidate_count", "normalized_candidate_team_ids")


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with audit_row, counted within league and season, by ``order``."""
    return df.withColumn("audit_row", F.row_number().over(Window.partitionBy("league", "season").orderBy(*order)))


def summary(audit: DataFrame, by: list[str]) -> DataFrame:
    return counted(audit, by)


def source_id_frequency(unresolved: DataFrame) -> DataFrame:
    """(league, season, source_player_id, n_rows, n_teams, n_names) of the source ids of unresolved rows, the most frequent first."""
    given = unresolved.withColumn("source_player_id", blank_to_null("source_player_id")).where("source_player_id is not null")
    return given.groupBy("league", "season", "source_player_id").agg(F.count("*").alias("n_rows"), F.count_distinct("team_id").alias("n_teams"), F.count_distinct("player_name").alias("n_names")).orderBy(F.desc("n_rows"), "league", "season", "source_player_id")


def disposition_queue(audits: dict[str, DataFrame]) -> DataFrame:
    """All audited rows under the union of their columns, with the dataset they are of and what becomes of them."""
    return union_diagonal([df.withColumn("dataset", F.lit(name)) for name, df in audits.items()])


def candidate_rows(audited: DataFrame, rosters: DataFrame, players: DataFrame, evidence: tuple[str, ...] | None = None) -> DataFrame:
    """The candidates of audited rows as rows: ``audited`` with candidate_season, candidate_team, candidate_player and candidate_name.

    Each row meets the roster members its own evidence class speaks of, and only
    rows of ``evidence`` classes are taken (without it those with one candidate,
    so that the result has one row each; names that many bear are asked for by
    naming the class).
    """
    wanted = evidence or tuple(one for _, one, _ in EVIDENCE if "SOURCE" not in one)
    own = audited.columns
    index = roster_index(rosters, players).select(*[F.col(c).alias(f"x{c}") for c in ("_league", "_season", "_team", "_exact", "_norm", "_surname", "_initial")], F.col("player").alias("candidate_player"), F.col("player_name").alias("candidate_name"))
    rows = _context(audited.where(F.col("evidence_class").isin(*wanted)))
    found = []
    for count, one, many in EVIDENCE[1:]:
        key = ["_surname", "_initial"] if count == "n_surname" else ["_exact" if count.endswith("exact") else "_norm"]
        same = "_season" if "other" not in count else "_league"
        other = "_season" if "other" in count else "_team"
        on = [F.col(k) == F.col(f"x{k}") for k in dict.fromkeys(["_league", same, *key])]
        met = rows.where(F.col("evidence_class").isin(one, many)).join(index, on).where(~F.col(other).eqNullSafe(F.col(f"x{other}")))
        found.append(met.select(*own, F.col("x_season").alias("candidate_season"), F.col("x_team").alias("candidate_team"), "candidate_player", "candidate_name"))
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out.distinct()
