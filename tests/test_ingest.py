"""The web source against a local server; recovery of what it landed; the streams."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from tallyspark.plans.recovery import audit_invalid, reconciliation, recover_all, recovery_findings, write_report
from tallyspark.sources.landing import load_recovery_report, read_invalid, read_overlay
from tallyspark.sources.web import extract_season, landed_path, query_of, read_requests
from tallyspark.streaming.landing import reasons_by_window, start, stream_invalid, stream_report_lines

ANSWERS = {
    "getleagueTeamsList": '{"league_teams_list": [{"id": "t1", "name": "Ants"}]}',
    "getcurrentSeasonSchedule": '{"schedule_games": [{"week_number": 1, "games": [{"game1": "g1"}]}]}',
    "getTeamRoster": '{"league": "l", "season": 1, "team": "Ants", "players": [{"player1": "p1", "Name": "Ann"}]}',
    "getGameStats": '{"home_stats": [ }]}',
    "getLeagueStandings": "[{\"team_name\": \"Ants\", \"w\": 1, \"l\": 0,},]",
    "getTeamStats": "no data",
    "getOffensiveStats": "",
    "getDefensiveStats": "{'a': [",
}
SEEN = []


class Handler(BaseHTTPRequestHandler):
    def do_GET(self):
        query = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        SEEN.append(query)
        first = sum(q["URI"] == query["URI"] for q in SEEN) == 1
        code = 503 if query["URI"] == "getScoringStats" and first else 404 if query["URI"] == "getSpecialTeamStats" else 200
        self.send_response(code)
        self.end_headers()
        self.wfile.write(ANSWERS.get(query["URI"], "[]").encode() if code == 200 else b"")

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def url():
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/rest/"
    server.shutdown()


def test_extract_recover_stream(spark, url, tmp_path):
    raw = tmp_path / "raw"
    rows = {(r["endpoint"], r["resource_id"]): r for r in extract_season(spark, url, str(raw), "wfa", 2020, delay=0).collect()}
    assert rows["scoring_stats", None]["valid"] and not rows["standings", None]["valid"] and rows["special_teams_stats", None]["path"] is None
    assert ("games", "g1") in rows and ("rosters", "t1") in rows and ("info", "p1") in rows and ("player_stats", "p1") in rows
    assert json.loads((raw / "wfa/2020/offensive_stats.json").read_text()) == []

    report = recover_all(spark, str(tmp_path))
    got = {r["endpoint"]: r for r in report.collect()}
    assert got["games"]["success"] and got["games"]["recovery_rule"] == "repair_malformed_empty_arrays" and (tmp_path / got["games"]["recovered_file"]).exists()
    assert got["standings"]["success"] and not got["team_stats"]["success"] and got["defensive_stats"]["category"] == "UNSUPPORTED"
    assert {r["endpoint"] for r in read_overlay(spark, str(tmp_path)).where("file like '%recovered%'").collect()} == {"games", "standings"}

    audit = audit_invalid(read_invalid(spark, str(tmp_path)))
    counts = {r["category"]: r for r in reconciliation(audit, report).collect()}
    assert counts["MALFORMED_GAME_DATA"]["outstanding"] == 0 and counts["MALFORMED_JSON"]["unattempted"] == 1
    assert {(r["level"], r["message"]) for r in recovery_findings(audit, report).collect()} >= {("INFO", "MALFORMED_GAME_DATA"), ("WARNING", "MALFORMED_JSON"), ("INFO", "NO_DATA")}

    write_report(report, str(tmp_path / "report"))
    back = load_recovery_report(spark, str(tmp_path / "report"))
    assert back.where("success").count() == 2 and back.count() == report.count()

    start(stream_invalid(spark, str(raw)), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    start(stream_invalid(spark, str(raw)), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert {(r["endpoint"], r["reason"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(r["endpoint"], r["reason"]) for r in audit.collect()}
    assert spark.read.parquet(str(tmp_path / "out")).count() == audit.count()
    assert reasons_by_window(spark.read.parquet(str(tmp_path / "out"))).agg({"n": "sum"}).first()[0] == audit.count()


def test_stream_of_lines(spark, tmp_path):
    spark.createDataFrame([(1, "f", "a,b")], "line_id long, report_file string, line_text string").write.parquet(str(tmp_path / "in"))
    lines = spark.readStream.schema("line_id long, report_file string, line_text string").parquet(str(tmp_path / "in"))
    start(stream_report_lines(lines), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first()["reason"] == "too few fields"


def test_requests(spark, url):
    assert query_of({"endpoint": "offensive_stats", "league": "l", "season": 1, "week": 0}) == {"URI": "getOffensiveStats", "league": "l", "season": 1, "week": 0}
    assert landed_path("rosters", "l", 1, "t", False) == "l/1/rosters/t.invalid.txt"
    (row,) = read_requests(spark, url, [{"endpoint": "special_teams_stats", "league": "l", "season": 1}], delay=0).collect()
    assert row["text"] is None and not row["valid"] and "404" in row["error"]
