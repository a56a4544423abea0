"""Drifting files: kinds of change, renames, unified tables."""

import json
from datetime import datetime

import pytest

from tallyspark.operators import schema_drift as S

ROW = "row_id long, stream_id string, feed string, league string, file_id string, as_of timestamp, delivered_at timestamp, rec_no int, payload string, cells string"


def feed(files):
    rows, n = [], 0
    for k, (file, records) in enumerate(files):
        for rec, payload in enumerate(records):
            rows.append((n, "s", "standings", "wfa", file, datetime(2020, 1, 1 + k), datetime(2020, 2, 1), rec, payload if isinstance(payload, str) or payload is None else json.dumps(payload), "clash"))
            n += 1
    return rows


NAMES = ["Ann Ash", "Bea Birch", "Cas Cedar", "Dee Dale", "Eve Elm"]


def test_changes(spark):
    files = [
        ("f0", [{"Team Name": NAMES[n % 5], "w": n, "pct": n / 7 + 0.01, "old": f"k-{n}"} for n in range(10)]),
        ("f1", [{"club": NAMES[n % 5], "w": n, "pct": 0.5 + n, "extra": f"row {n} of it"} for n in range(10)]),
        ("f2", [{"club": NAMES[n % 5], "w": str(n), "pct": 1.5 if n else "N/A"} for n in range(10)] + [{"w": None}]),
        ("f3", [{"club": NAMES[n % 5], "w": "NR", "pct": 0.5, "extra": True} for n in range(10)] + ["not json", None, "[1]"]),
    ]
    rows = feed(files)
    late = [(n + 1000, *r[1:]) for n, r in enumerate(rows[:5])]
    got = {tuple(r[2:]) for r in S.schema_changes(S.load_cells(spark.createDataFrame(rows + late, ROW))).collect()}
    assert got == {
        ("f1", "renamed", "team_name", "club"), ("f1", "removed", "old", ""), ("f1", "added", "", "extra"),
        ("f2", "retyped", "w", "w"), ("f2", "removed", "extra", ""), ("f3", "added", "", "extra"), ("f2", "retyped", "pct", "pct"), ("f3", "retyped", "pct", "pct"),
    } - {("f2", "retyped", "pct", "pct"), ("f3", "retyped", "pct", "pct")}


def test_kinds():
    cells = {c["name"]: c["kind"] for c in S.record_cells('{"a": 1, "b": 1.0, "c": "x", "d": true, "e": null, "f": " NR ", "G-h  i": 2, "n": {"m": [1]}}')}
    assert cells == {"a": "integer", "b": "decimal", "c": "text", "d": "boolean", "e": "null", "f": "null", "g_h_i": "integer", "n.m": "text"}
    assert S.record_cells("{") is None and S.record_cells(None) is None


def test_table_and_failed_casts(spark):
    files = [("f0", [{"w": n, "name": f"t {n}"} for n in range(9)] + [{"w": "many"}]), ("f1", [{"W": str(n)} for n in range(9)])]
    drifted = S.DriftedFeeds(spark.createDataFrame(feed(files), ROW))
    assert drifted.types == {"standings": {"w": "long", "name": "string"}}
    assert drifted.table("standings").agg({"w": "sum"}).first()[0] == 72
    assert drifted.table("standings").count() == 19
    assert [(r["file_id"], r["column_name"], r["n_failed"], r["example"]) for r in drifted.failed_casts().collect()] == [("f0", "w", 1, "many")]


def test_empty(spark):
    empty = spark.createDataFrame([], ROW)
    assert S.schema_changes(S.load_cells(empty)).count() == 0
    assert S.DriftedFeeds(empty).table("standings").count() == 0


@pytest.mark.parametrize(("raw", "clean"), [(" Win Pct ", "win_pct"), ("a--b", "a_b"), ("_X_", "x")])
def test_clean_key(raw, clean):
    assert S.clean_key(raw) == clean
