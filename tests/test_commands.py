"""The commands, from landed documents to exported marts."""

import csv
import json
import subprocess
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tallyspark.__main__ import main
from tallyspark.plans.audits import run_audits
from tallyspark.sources.tables import TABLES

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")

    def put(path, value):
        target = root / "raw" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(value if isinstance(value, str) else json.dumps(value))

    team = [{"id": "t1", "name": "Ants", "city": "Elm", "conf": "Div 2", "div": "East"}, {"id": "t2", "name": "Bees", "city": "Oak"}]
    put("wfa/2020/teams.json", {"league_teams_list": team})
    put("wnfc/2020/teams.json", {"league_teams_list": [{"id": "t3", "name": "Cats", "city": "Fir"}]})
    for t, name, people in (("t1", "Ants", [("p1", "Ann Ash"), ("p2", "Bea Birch")]), ("t2", "Bees", [("p3", "Cas Cedar")])):
        put(f"wfa/2020/rosters/{t}.json", {"league": "wfa", "season": 2020, "team": name, "players": [{"player1": p, "Name": n} for p, n in people]})
    put("wfa/2020/schedule.json", {"schedule_games": [{"week_number": 1, "games": [{"game1": "g1", "date": "May 1", "home": "Ants", "visitor": "Bees", "home_score": 7, "visitor_score": 0}]}]})
    side = {"game_data": [{"home_team_id": "t1", "home_team": "Ants", "visitor_team_id": "t2", "visitor_team": "Bees", "date": "May 1"}]}
    lines = [{"player_id": "s1", "player_name": "ann ash", "rushing_yards": 5}, {"player_id": "s9", "player_name": "Cas Cedar"}]
    put("wfa/2020/games/g1.json", side | {"home_stats": [{"player_number_7": lines[:1], "player_number_8": lines[1:]}], "visitor_stats": []})
    put("wfa/2020/games/g2.invalid.txt", '{"home_stats": [ }]}')
    put("wfa/2020/offensive_stats.json", {"list": [{"player_name": "Ann Ash", "team_name": "Ants", "team_city": "Elm", "rushing_yards": 5, "passing_attempts": 0}]})
    put("wfa/2020/team_stats.json", {"stats": [{"team_name": "Ants", "team_city": "Elm", "total_points": 7}, {"team_name": "Nobody", "team_city": "X", "total_points": 7}]})
    put("wfa/2020/standings.json", {"Div 2": {"x": [{"team_name": "Ants", "w": 1, "l": 0, "t": 0, "pct": 1.0}]}})
    return root


def test_recover_normalize_audit(spark, landed, capsys):
    assert main(["recover", "--root", str(landed)]) == 0
    assert "repair_malformed_empty_arrays" in capsys.readouterr().out and (landed / "recovered/wfa/2020/games/g2.json").exists()
    assert main(["normalize", "--root", str(landed), "--tables", str(landed / "tables")]) == 0
    assert main(["leagues", "--tables", str(landed / "tables")]) == 0 and "wnfc: 1 seasons" in capsys.readouterr().out
    assert main(["audit", "--tables", str(landed / "tables"), "--out", str(landed / "audits")]) == 0
    (queue,) = (landed / "audits/disposition_summary").glob("*.csv")
    with open(queue, newline="") as f:
        rows = {(r["dataset"], r["disposition"]): int(r["count"]) for r in csv.DictReader(f)}
    assert rows == {("player_game_stats", "SOURCE_PLAYER_IDENTITY_AMBIGUOUS"): 1, ("team_season_stats", "TEAM_SOURCE_UNRESOLVED"): 1}


def test_candidates_are_named(spark, landed):
    outputs = run_audits({t: spark.read.parquet(f"{landed}/tables/{t}.parquet") for t in TABLES})
    assert len(outputs) == 9
    (row,) = outputs["candidate_evidence"].collect()
    assert (row["candidate_player"], row["candidate_name"], row["candidate_team"], row["candidate_team_name"]) == ("p3", "Cas Cedar", "t2", "Bees")
    (source,) = outputs["source_id_evidence"].collect()
    assert (source["source_player_id"], source["n_rows"]) == ("s9", 1)


def test_validate_publish_export(spark, landed, capsys):
    tables, releases = str(landed / "tables"), str(landed / "releases")
    assert main(["validate", "--tables", tables]) == 0
    assert main(["validate", "--tables", str(landed / "nothing")]) == 1
    assert main(["publish", "--tables", tables, "--releases", releases, "--version", "1.0.0"]) == 0
    assert main(["publish", "--tables", tables, "--releases", releases, "--version", "1.0.0"]) == 1
    assert main(["export", "--releases", releases]) == 0
    assert pq.read_table(f"{releases}/v1.0.0/analytics/mart_player_game_logs.parquet").num_rows == 2
    assert main(["export", "--releases", str(landed / "nothing")]) == 1
    assert "nothing has been published" in capsys.readouterr().err


def test_workers_import_the_package_from_any_folder(tmp_path):
    """A driver that finds the package by sys.path alone, in another folder: what runs on workers still finds it."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from tallyspark.session import make_session
from tallyspark.functions.people import normalised_name
from pyspark.sql import functions as F
spark = make_session("local[1]", 1)
print(spark.createDataFrame([("Zoé",)], "n string").select(normalised_name(F.col("n"))).first()[0])
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=280)
    assert done.stdout.strip() == "zoe", done.stderr[-2000:]
