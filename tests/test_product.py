"""Contracts, rules, audit, marts and releases."""

import json
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import audit, quality
from tallyspark.plans import release
from tallyspark.plans.models import CAREER_SUMS, Models

TEAMS = "league string, season long, team_id string, team_name string"


def teams(spark, *rows):
    return spark.createDataFrame(list(rows), TEAMS)


@pytest.mark.parametrize(("text", "name"), [("0.1.0", "v0.1.0"), ("v1.2.3", "v1.2.3")])
def test_versions(text, name):
    assert release.release_version(text) == name


@pytest.mark.parametrize("text", ["phase-two", "0.1"])
def test_no_versions(text):
    with pytest.raises(ValueError):
        release.release_version(text)


def test_contracts(spark):
    one = teams(spark, ("wfa", 2026, "team-1", "Example"))
    contract = quality.contract_of("teams")
    assert contract.problems(one) == [] and contract.problems(one.withColumn("season", F.col("season").cast("int"))) == []
    assert "team_name" in contract.problems(one.drop("team_name"))[0]
    assert "season" in contract.problems(one.withColumn("season", F.col("season").cast("string")))[0]
    assert "duplicate" in contract.problems(one.union(one))[0]
    with pytest.raises(KeyError):
        quality.contract_of("nothing")
    with pytest.raises(ValueError):
        quality.enforce({"teams": one.union(one)})


def test_findings(spark):
    t = teams(spark, ("l", 1, "a", "A"), ("l", 1, "a", None), (None, 1, "b", "B"), (None, 1, "b", "B"))
    got = {(r["check_name"], r["message"]): (r["level"], r["count"]) for r in quality.check_table("teams", t).collect()}
    assert got == {("not_null", "league"): ("ERROR", 2), ("not_null", "team_name"): ("ERROR", 1), ("unique", "league, season, team_id"): ("ERROR", 2)}
    assert quality.check_table("teams", t.limit(0)).count() == 0
    assert [(r["check_name"], r["count"]) for r in quality.check_table("players", spark.createDataFrame([("p",)], "player_id string")).collect()] == [("required_columns", 1)]
    roster = spark.createDataFrame([("l", 1, "a", "p", "x"), ("l", 1, "z", "p", "x"), ("l", 1, None, "q", "x")], "league string, season long, team_id string, player_id string, team_name string")
    found = {r["message"]: r["count"] for r in quality.check_table("rosters", roster, tables={"teams": t, "players": spark.createDataFrame([("p", "n")], "player_id string, player_name string")}).where("check_name = 'foreign_key'").collect()}
    assert found == {"league, season, team_id -> teams": 2, "player_id -> players": 1}


def test_audit_outcomes(spark):
    players = spark.createDataFrame([("p1", "Ann Ash"), ("p2", "Ann Ash"), ("p3", "Béa Birch"), ("p4", "Cas Cedar"), ("p5", "Dee Dale"), ("p6", "Eve Élm"), ("p7", "Fay Fir")], "player_id string, player_name string")
    rosters = spark.createDataFrame([("l", s, t, p) for s, t, p in [(1, "a", "p1"), (1, "a", "p2"), (1, "a", "p3"), (1, "b", "p4"), (2, "a", "p5"), (2, "a", "p6"), (1, "b", "p7"), (1, "c", "p7")]], "league string, season long, team_id string, player_id string")
    cases = [
        (1, 1, None, "x", None, "MISSING_IDENTITY_CONTEXT", "NO_CROSS_ROSTER_EVIDENCE", "SOURCE_IDENTITY_CONTEXT_MISSING"),
        (2, 1, "z", "x", None, "NO_ROSTER_FOR_TEAM_SEASON", "NO_CROSS_ROSTER_EVIDENCE", "SOURCE_ROSTER_MISSING"),
        (3, 1, "a", " ", None, "MISSING_PLAYER_NAME", "NO_CROSS_ROSTER_EVIDENCE", "SOURCE_IDENTITY_CONTEXT_MISSING"),
        (4, 1, "a", "ann ash", None, "EXACT_NAME_AMBIGUOUS", "NO_CROSS_ROSTER_EVIDENCE", "SOURCE_PLAYER_IDENTITY_AMBIGUOUS"),
        (5, 1, "a", "Bea Birch", None, "NORMALIZED_NAME_UNIQUE_CANDIDATE", "NO_CROSS_ROSTER_EVIDENCE", "NO_IDENTITY_EVIDENCE"),
        (6, 1, "a", "…", None, "MISSING_NORMALIZED_NAME", "NO_CROSS_ROSTER_EVIDENCE", "SOURCE_IDENTITY_CONTEXT_MISSING"),
        (7, 1, "a", "Cas Cedar", None, "NO_PLAYER_CANDIDATE_ON_ROSTER", "POSSIBLE_TEAM_TRANSFER_EXACT_NAME", "SOURCE_PLAYER_IDENTITY_AMBIGUOUS"),
        (8, 1, "a", "Dee Dale", None, "NO_PLAYER_CANDIDATE_ON_ROSTER", "PLAYER_EXISTS_OTHER_SEASON_EXACT_NAME", "CROSS_SEASON_IDENTITY_ONLY"),
        (9, 1, "a", "Eve Elm", None, "NO_PLAYER_CANDIDATE_ON_ROSTER", "PLAYER_EXISTS_OTHER_SEASON_NORMALIZED_NAME", "NAME_VARIANT_REVIEW"),
        (10, 1, "a", "C. Cedar", None, "NO_PLAYER_CANDIDATE_ON_ROSTER", "POSSIBLE_NAME_VARIANT_SURNAME_INITIAL", "NAME_VARIANT_REVIEW"),
        (11, 1, "a", "Who Else", None, "NO_PLAYER_CANDIDATE_ON_ROSTER", "NO_CROSS_ROSTER_EVIDENCE", "SOURCE_PLAYER_NOT_ON_ROSTER"),
        (12, 1, "a", "Fay Fir", None, "NO_PLAYER_CANDIDATE_ON_ROSTER", "SAME_SEASON_EXACT_NAME_MULTIPLE_TEAMS", "SOURCE_PLAYER_IDENTITY_AMBIGUOUS"),
        (13, 1, "a", "Who Else", "s1", "NO_PLAYER_CANDIDATE_ON_ROSTER", "SOURCE_PLAYER_ID_UNIQUE_LINK", "NO_IDENTITY_EVIDENCE"),
        (14, 1, "a", "béa birch", None, "EXACT_NAME_UNIQUE_CANDIDATE", "NO_CROSS_ROSTER_EVIDENCE", "NO_IDENTITY_EVIDENCE"),
    ]
    kinds = "row_id long, league string, season long, team_id string, player_name string, source_player_id string, player_id string"
    rows = spark.createDataFrame([(n, "L", s, t, name, src, None) for n, s, t, name, src, *_ in cases], kinds)
    resolved = spark.createDataFrame([(99, "l", 1, "a", "n", "s1", "p1")], kinds)
    got = {r["row_id"]: (r["diagnosis"], r["evidence_class"], r["disposition"]) for r in audit.audit_players(rows, rosters, players, resolved).collect()}
    assert got == {c[0]: c[5:] for c in cases}
    audited = audit.audit_players(rows, rosters, players)
    found = {(r["row_id"], r["candidate_player"], r["candidate_season"]) for r in audit.candidate_rows(audited, rosters, players).collect()}
    assert found == {(7, "p4", "1"), (8, "p5", "2"), (9, "p6", "2"), (10, "p4", "1")}
    several = audit.candidate_rows(audited, rosters, players, ("SAME_SEASON_EXACT_NAME_MULTIPLE_TEAMS",))
    assert {(r["row_id"], r["candidate_team"]) for r in several.collect()} == {(12, "b"), (12, "c")}
    queue = audit.disposition_queue({"players": audited, "teams": rows.limit(1).withColumn("disposition", F.lit("TEAM_SOURCE_UNRESOLVED"))})
    assert queue.groupBy("dataset").count().count() == 2
    summed = audit.summary(audit.audit_players(rows, rosters, players), ["disposition"])
    assert summed.agg({"count": "sum"}).first()[0] == len(cases)


def test_team_audit(spark):
    known = teams(spark, ("l", 1, "a", "Ants"), ("l", 1, "b", "Bées"), ("l", 1, "c", "Twins"), ("l", 1, "d", "twins"))
    rows = spark.createDataFrame([(1, "l", 1, None, "ants"), (2, "l", 1, None, "Bees"), (3, "l", 1, None, "Twins"), (4, "l", 1, None, None)], "row_id long, league string, season long, team_id string, team_name string")
    got = {r["row_id"]: r["diagnosis"] for r in audit.audit_teams(rows, known).collect()}
    assert got == {1: "EXACT_TEAM_NAME_UNIQUE_CANDIDATE", 2: "NORMALIZED_TEAM_NAME_UNIQUE_CANDIDATE", 3: "EXACT_TEAM_NAME_AMBIGUOUS", 4: "NO_TEAM_CANDIDATE"}


@pytest.fixture(scope="module")
def models(spark):
    sums = [c for c in CAREER_SUMS if c != "games_with_stats"]
    stat = ", ".join(f"{c} double" for c in dict.fromkeys([*sums, "passing_long", "completion_pct", "passing_average", "passer_rating"]))
    season = {c: 0.0 for c in sums} | {"passing_attempts": 20.0, "passing_completions": 13.0, "passing_yards": 250.0, "pass_tds": 2.0, "passing_interceptions": 1.0}
    row = [season.get(c, None) for c in dict.fromkeys([*sums, "passing_long", "completion_pct", "passing_average", "passer_rating"])]
    at = datetime(2020, 1, 1)
    return Models({
        "teams": teams(spark, ("wfa", 2020, "a", "Ants"), ("wfa", 2020, "b", "Bees")),
        "players": spark.createDataFrame([("p", "Ann")], "player_id string, player_name string"),
        "rosters": spark.createDataFrame([("wfa", 2020, "a", "Ants", "p", "7")], "league string, season long, team_id string, team_name string, player_id string, roster_number string"),
        "games": spark.createDataFrame([("wfa", 2020, "g", "regular", 1, date(2020, 5, 1), "BEES ", "ants", 7)], "league string, season long, game_id string, season_type string, week long, date date, visitor_team_name string, home_team_name string, home_score long"),
        "player_game_stats": spark.createDataFrame([("wfa", 2020, "g", None, "a", "Ants", "s", "p", "typed", 9, at), ("wfa", 2020, "h", None, "a", "Ants", "s", None, "typed", 9, at)], "league string, season long, game_id string, date date, team_id string, team_name string, source_player_id string, player_id string, player_name string, week long, loaded_at timestamp"),
        "player_season_stats": spark.createDataFrame([("wfa", 2020, "a", "p", "typed", "x", *row), ("wfa", 2020, None, None, "nobody", "x", *[None] * len(row))], f"league string, season long, team_id string, player_id string, player_name string, team_name string, {stat}"),
        "team_season_stats": spark.createDataFrame([("wfa", 2020, "a", "Ants", "logo1")], "league string, season long, team_id string, team_name string, team_logo string"),
        "standings": spark.createDataFrame([("wfa", 2020, " ANTS", 3, 1, 0, 0.75, "logo2")], "league string, season long, team_name string, wins long, losses long, ties long, win_pct double, team_logo string"),
    })


def test_marts(models):
    logs = {r["game_id"]: r for r in models.mart_player_game_logs().collect()}
    assert (logs["g"]["game_location"], logs["g"]["opponent_team_name"], logs["g"]["player_name"], logs["g"]["week"], logs["g"]["week_1"], str(logs["g"]["date"])) == ("home", "BEES ", "Ann", 1, 9, "2020-05-01")
    assert logs["h"]["game_location"] is None and logs["h"]["week"] is None and not logs["h"]["has_canonical_player"] and logs["h"]["player_name"] == "typed"
    (qb,) = models.mart_qb_season_stats().collect()
    assert round(qb["passer_rating_calculated"], 4) == 120.8333 and qb["games_with_stats"] == 1 and qb["passing_tds"] == 2.0
    (career,) = models.mart_player_career_stats().collect()
    assert (career["career_completion_pct"], career["career_yards_per_carry"], career["passing_tds"], career["games_with_stats"]) == (65.0, None, 2.0, 1)
    (team,) = models.mart_team_season_summary().collect()
    assert (team["wins"], team["team_logo"], team["team_logo_1"], team["games_scheduled"]) == (3, "logo1", "logo2", 1)
    assert models.league_view("wnfc", "mart_players").count() == 0 and models.league_view("wfa", "mart_players").count() == 1
    with pytest.raises(KeyError):
        models.core("mart_nothing")


def test_views(spark, models):
    models.create_views()
    assert spark.sql("select count(*) from mart_wfa_player_game_logs").first()[0] == 2 and spark.catalog.tableExists("stg_teams")


def test_release(spark, models, tmp_path):
    tables = {"teams": teams(spark, ("wfa", 2025, "a", "A"), ("wfa", 2026, "b", "B"), ("wnfc", 2026, "c", "C")), "players": spark.createDataFrame([("p", "n"), ("q", "m")], "player_id string, player_name string")}
    target = release.publish(tables, "0.2.0", tmp_path)
    manifest = json.loads((target / "manifest.json").read_text())
    assert manifest["release_version"] == "v0.2.0" and manifest["dataset_count"] == 2 and manifest["total_rows"] == 5
    (entry,) = [e for e in manifest["datasets"] if e["dataset"] == "teams"]
    assert len(entry["partitions"]) == 3 and len(entry["sha256"]) == 64 and all(len(p["sha256"]) == 64 for p in entry["partitions"])
    assert entry["sha256"] == release.file_checksum(target / "datasets/teams.parquet")
    assert pq.ParquetFile(target / "datasets/teams.parquet").metadata.row_group(0).column(0).compression == "ZSTD"
    assert json.loads((tmp_path / "latest.json").read_text()) == {"latest": "v0.2.0"} and (target / "data_dictionary.md").exists()
    with pytest.raises(release.ReleaseError):
        release.publish(tables, "0.2.0", tmp_path)
    release.publish(tables, "0.2.0", tmp_path, force=True)
    with pytest.raises(release.ReleaseError):
        release.publish({"teams": tables["teams"].union(tables["teams"])}, "0.3.0", tmp_path)
    assert not (tmp_path / "v0.3.0").exists()
    exported = release.export_marts({"mart_players": models.mart_players()}, "0.2.0", tmp_path)
    assert exported["datasets"][0]["row_count"] == 1
    with pytest.raises(release.ReleaseError):
        release.export_marts({}, "9.9.9", tmp_path)


def test_marts_and_coverage(spark, models):
    from tallyspark.operators import quality

    found = {(r["table_name"], r["check_name"], r["message"]): r["count"] for r in quality.check_marts({n: models.core(n) for n in Models.CORE}).collect()}
    assert found == {}
    bad = spark.createDataFrame([("nfl", 2020, None, "A", "p"), (None, 2020, "t", "A", "p")], "league string, season long, team_id string, team_name string, player_id string")
    found = {(r["check_name"], r["message"]): r["count"] for r in quality.check_marts({"mart_players": bad}).collect()}
    assert found == {("not_null", "team_id"): 1, ("not_null", "league"): 1, ("accepted_values", "league"): 1}
    empty = {n: spark.createDataFrame([], ", ".join(f"{c} {'bigint' if k == 'long' else k}" for c, k in quality.CONTRACTS[n].columns.items())) for n in ("standings", "player_game_stats")}
    found = {(r["level"], r["table_name"], r["check_name"]) for r in quality.check_all(empty, ("standings", "teams")).collect()}
    assert found == {("INFO", "standings", "coverage"), ("ERROR", "teams", "table_exists")}
    lines = spark.createDataFrame([("p", 1), (None, 2), (None, 3)], "player_id string, week long")
    shares = [r["message"] for r in quality.check_table("player_game_stats", lines, required=[]).where("check_name = 'share'").collect()]
    assert shares == ["unresolved_player: 66.67 % of the rows"]


def test_release_read_back(spark, models, tmp_path, monkeypatch):
    tables = {"teams": teams(spark, ("wfa", 2025, "a", "A"), (None, 2026, "b", "B")), "team_season_stats": spark.createDataFrame([("wfa", 2020, "a", "A")] * 2 + [("wfa", 2020, None, "A")] * 2, "league string, season long, team_id string, team_name string")}
    root = tmp_path / "releases"
    monkeypatch.setattr(release, "SINGLE_FILE_ROWS", 3)
    target = release.publish(tables, "1.0.0", root, validate=False, pointer=False)
    assert not (root / "latest.json").exists()
    manifest = {e["dataset"]: e for e in json.loads((target / "manifest.json").read_text())["datasets"]}
    assert manifest["team_season_stats"]["duplicate_keys"] == 1 and "parts" in manifest["team_season_stats"] and (target / "datasets/team_season_stats.parquet").is_dir()
    assert any("league=__NULL__" in p["path"] for p in manifest["teams"]["partitions"])
    dictionary = json.loads((target / "data_dictionary.json").read_text())
    assert dictionary["teams"]["grain"] and all(c["description"] for c in dictionary["teams"]["columns"])
    with pytest.raises(release.ReleaseError):
        release.latest_release(root)
    release.publish(tables, "1.1.0", root, validate=False)
    assert release.latest_release(root) == "v1.1.0" and release.release_tables(spark, root)["team_season_stats"].count() == 4


def test_tables_by_name(spark, tmp_path):
    from tallyspark.sources.tables import MissingTables, load_tables

    spark.createDataFrame([("t", "A, \"x\"")], "team_id string, team_name string").write.parquet(f"{tmp_path}/teams.parquet")
    (tmp_path / "players.csv").write_text('player_id,player_name\np,"Ann ""A"" Ash"\n')
    got = load_tables(spark, str(tmp_path), ("teams", "players"))
    assert got["players"].first()["player_name"] == 'Ann "A" Ash' and got["teams"].count() == 1
    with pytest.raises(MissingTables, match="games, rosters"):
        load_tables(spark, str(tmp_path), ("teams", "games", "rosters"))
