"""Landed documents to canonical tables; repair and classification of texts."""

import json

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import documents as D
from tallyspark.operators import repair
from tallyspark.plans.canonical import Canonical, game_date
from tallyspark.sources.landing import load_recovery_report, read_csv, read_invalid, read_overlay


def land(root, path, value):
    file = root / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(value if isinstance(value, str) else json.dumps(value))


@pytest.fixture
def folder(tmp_path):
    land(tmp_path, "raw/wfa/2023/teams.json", {"x": {"league_teams_list": [{"id": "t1", "team#": "1", "city": "A", "name": "Ants", "conf": "Div 2", "div": "East"}, {"id": "t1", "name": "Later"}]}})
    land(tmp_path, "raw/wfa/2023/rosters/t1.json", {"league": "wfa", "season": 2023, "team": "Ants", "players": [{"player1": "p1", "Number": 7, "Name": "Ann O&amp;Neil", "Pos": "QB"}, {"player2": ""}, {"player3": "p3", "Name": "Bea"}]})
    land(tmp_path, "raw/wfa/2023/schedule.json", {"schedule_games": [{"psw": 1, "games": [{"game1": "g1", "date": "May 1", "visitor": "Bees", "visitor_score": "7", "home": "Ants", "home_score": "12.0"}]}]})
    land(tmp_path, "recovered/wfa/2023/teams.json", {"league_teams_list": []})
    game = {"game_data": [{"home_team_id": "t1", "home_team": "Ants", "visitor_team_id": "t2", "visitor_team": "Bees", "week_number": 1, "date": "2023-05-01"}], "home_stats": [{"player_number_7": [{"player_id": "s9", "player_name": " ann o&neil", "ints": "1"}]}, {"player_number_8": [{"player_id": "s9", "player_name": "zz"}], "other_1": [{}]}]}
    land(tmp_path, "recovered/wfa/2023/games/g1.json", game)
    land(tmp_path, "raw/wfa/2023/offensive_stats.json", {"a": [{"player_name": "Ann O&Neil", "team_city": " A", "team_name": "Ants ", "rank": 1, "passing_yards": 100, "tds": 9}]})
    land(tmp_path, "raw/wfa/2023/scoring_stats.json", {"a": [{"player_name": "Ann O&Neil", "team_city": " A", "team_name": "Ants ", "tds": 2, "passing_yards": None}]})
    land(tmp_path, "raw/wfa/2023/standings.json", {"WFA League Standings": {"Div 2": {"East Conference": [{"team_name": "Ants", "w": 1, "l": "0", "pct": "1.000"}]}}})
    land(tmp_path, "raw/wfa/notes/teams.json", {"league_teams_list": [{"id": "no"}]})
    land(tmp_path, "raw/wfa/2023/games/g2.invalid.txt", "no data")
    return tmp_path


def test_canonical_tables(spark, folder):
    tables = Canonical(read_overlay(spark, str(folder))).tables()
    (team,) = tables["teams"].collect()
    assert (team["team_name"], team["tier"], team["conference"], team["division"]) == ("Ants", "Div 2", "East", None)
    assert {r["player_id"]: r["player_name"] for r in tables["players"].collect()} == {"p1": "Ann O&Neil", "p3": "Bea"}
    (game,) = tables["games"].collect()
    assert (game["season_type"], str(game["date"]), game["visitor_score"], game["home_score"]) == ("postseason", "2023-05-01", 7, None)
    lines = {r["player_name"]: r for r in tables["player_game_stats"].collect()}
    assert lines["ann o&neil"]["player_id"] == "p1" and lines["zz"]["player_id"] == "p1" and lines["ann o&neil"]["interceptions"] == 1.0
    (season,) = tables["player_season_stats"].collect()
    assert (season["passing_yards"], season["tds"], season["team_id"], season["player_id"]) == (100.0, 2.0, "t1", None) or season["player_id"] == "p1"
    (standing,) = tables["standings"].collect()
    assert (standing["tier"], standing["conference"], standing["wins"], standing["win_pct"]) == ("Div 2", "East Conference", 1, 1.0)
    (bad,) = read_invalid(spark, str(folder)).collect()
    assert (bad["endpoint"], bad["resource_id"], bad["season"], bad["size_bytes"]) == ("games", "g2", 2023, 7)


def test_no_documents(spark, tmp_path):
    assert read_overlay(spark, str(tmp_path)).count() == 0


def test_walkers():
    doc = {"a": {"X": []}, "b": [{"x": [1]}], "game12": "g", "n": {"game12": "g", "game3": " "}}
    assert D.first_list(doc, "x") == [1] and D.first_list({"x": [], "y": {"x": [2]}}, "x") == []
    assert D.ids_of(doc, "game") == ["g"] and D.values_of(doc, "x") == [[], [1]]
    assert D.clean_record({"Pct": " .5 ", "pct": "NR"}) == {"win_pct": None}


def test_dates(spark):
    df = spark.createDataFrame([("2023-05-01", 2023), ("May 1", 2023), ("Sep  7", 2021), ("soon", 2021), (None, 2021), ("May 1", None)], "d string, s long")
    assert [str(r[0]) for r in df.select(game_date(F.col("d"), F.col("s"))).collect()] == ["2023-05-01", "2023-05-01", "2021-09-07", "None", "None", "None"]


REPAIRS = [
    ('{"home_stats": [ }]}', "games", "MALFORMED_GAME_DATA", "repair_malformed_empty_arrays"),
    ('[{"team_name":"A",},]', "standings", "MALFORMED_STANDINGS_DATA", "remove_trailing_commas"),
    ('{"a":[1]}]', "standings", "MALFORMED_STANDINGS_DATA", "trim_trailing_extra_closers"),
    ('{"a":[{"b":1}', "standings", "MALFORMED_STANDINGS_DATA", "append_missing_closers:]}"),
    ("{'a': 1, 'b': None}", "offensive_stats", "PYTHON_LITERAL", "ast_literal_eval"),
    ('{"n":"A\tB"}', "rosters", "PYTHON_LITERAL", "escape_raw_control_characters"),
    ('{"player_stat_totals": [ { ] }', "stats", "EMPTY_PLAYER_STATS", None),
    ('{"a":1}', "teams", "VALID_JSON", None),
    ("no roster", "rosters", "UNSUPPORTED", None),
    ("", "rosters", "UNSUPPORTED", None),
    ("{]", "standings", "MALFORMED_STANDINGS_DATA", None),
]


@pytest.mark.parametrize(("text", "endpoint", "category", "rule"), REPAIRS)
def test_repairs(text, endpoint, category, rule):
    out = repair.recover(text, endpoint)
    assert (out["category"], out["recovery_rule"], out["success"]) == (category, rule, rule is not None)
    assert out["recovered"] is None or json.loads(out["recovered"]) is not None


def test_classes(spark):
    cases = [("", None, "EMPTY"), (None, None, "EMPTY"), ("Page Not Found", None, "NO_DATA"), ('{"player_stat_totals": [ { ] }', "stats", "EMPTY_PLAYER_STATS"), ("<!DOCTYPE html>x", None, "HTML_RESPONSE"), ("Bad Gateway", None, "API_ERROR"), ("[1]", None, "VALID_JSON_MARKED_INVALID"), ("{'a': 1}", "games", "PYTHON_LITERAL"), ('{"a":', "games", "MALFORMED_GAME_DATA"), ('{"a":', "standings", "MALFORMED_STANDINGS_DATA"), ('{"a":', None, "MALFORMED_JSON"), ("plain words", None, "TEXT_RESPONSE"), ("\x01\x02\x03a", None, "UNKNOWN")]
    df = spark.createDataFrame(cases, "t string, e string, want string").withColumn("got", repair.classify_response(F.col("t"), F.col("e")))
    assert [(r["t"], r["got"]) for r in df.collect() if r["got"] != r["want"]] == []


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('season,name\n2020,"a ""b"""\nNR,-\nx,c\n')
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "t.csv"), "season long, name string").collect()] == [(2020, 'a "b"'), (None, None), (None, "c")]
    assert load_recovery_report(spark, str(tmp_path / "t.csv")).count() == 0
    assert load_recovery_report(spark, str(tmp_path / "none.csv")).count() == 0
