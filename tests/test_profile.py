"""Column profile: counts, forms, change, failed loads at their limits."""

from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import profile as P

RANGE = {("t", "week"): (1, 20)}


def counts(spark, loads):
    rows = [(load, x, "clash") for load, xs in loads.items() for x in xs]
    return P.value_counts(spark.createDataFrame(rows, "load_id string, week long, value string"), "t", ["week"], F.col("load_id"))


def failed(spark, loads):
    return {r["load_id"] for r in P.failed_loads(counts(spark, loads), RANGE).collect()}


def test_limits(spark):
    even = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10] * 20
    assert failed(spark, {"a": even, "b": even}) == set()
    assert failed(spark, {"a": even, "nulls": [*even[:80], *[None] * 20], "fewer": [*even[:81], *[None] * 19]}) == {"nulls"}
    assert failed(spark, {"a": even, "out": [*even[:90], *[21] * 10], "in": [*even[:91], *[21] * 9]}) == {"out"}
    assert failed(spark, {"a": even, "two": [5, 6] * 50}) == {"two"}
    # shares not above 5 of 0.50 in the rest: 0.95 departs by 0.45 exactly, 0.94 doesn't
    assert failed(spark, {"a": even, "b": even, "low": [1, 2, 3, 4, 5] * 19 + [10] * 5}) == {"low"}
    assert failed(spark, {"a": even, "b": even, "near": [1, 2, 3, 4, 5] * 18 + [4, 5, 3] + [10] * 7}) == set()


def test_only_load_and_empty(spark):
    assert failed(spark, {"a": [1, 2, 3]}) == set()
    assert failed(spark, {"a": [None, None]}) == {"a"}
    assert failed(spark, {}) == set()
    assert failed(spark, {None: [7]}) == {""}


def test_running_counts_against_brute_force(spark):
    xs = [0.0, -1.5, 3.25, 3.25, 1e9, -1e9, 0.001, 2.0, 2.0, 2.0]
    df = spark.createDataFrame([(x,) for x in xs], "number double").groupBy("number").agg(F.count("*").alias("n")).withColumn("g", F.lit(1))
    got = {r["number"]: r["upto"] for r in P.running_counts(df, ["g"]).collect()}
    assert got == {x: sum(y <= x for y in xs) for x in xs}


def test_profile_and_change(spark):
    c = counts(spark, {"a": [1, 1, None, 12], "b": [30, 30, 30, 30]})
    row = P.column_profile(c).first()
    assert (row["n_rows"], row["n_null"], row["n_distinct"], row["min_number"], row["max_number"], row["main_form"]) == (8, 1, 3, 1.0, 30.0, "9")
    change = {r["load_id"]: r for r in P.population_stability(c).collect()}
    assert change["b"]["psi"] > 5 and abs(change["a"]["chi_square"] - 8.0) < 1e-9


def test_stability_index_against_brute_force(spark):
    loads = {"a": [1, 2, 3, 4, 5] * 20, "b": [1, 2, 3, 4, 5] * 10 + [None, 6], "lost": [5, 5, 7], "other": [8, 9], None: [1, 2, None]}

    def share(xs, x):
        return max(Counter(xs)[x] / len(xs), 1e-4)

    want = {}
    for load, xs in loads.items():
        rest = [x for k, ys in loads.items() if k != load for x in ys]
        want[load] = sum((share(xs, x) - share(rest, x)) * log(share(xs, x) / share(rest, x)) for x in {*xs, *rest})
    got = {r["load_id"]: r["psi"] for r in P.population_stability(counts(spark, loads)).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_all_domain_tables_are_profiled(spark):
    from tallyspark.plans import data_queries as Q
    from tallyspark.sources.tables import table

    d = "/root/testdata/sf0.001"
    tables = {t: table(spark, d, t) for t in ("teams", "players", "rosters", "games", "player_game_stats", "player_season_stats", "team_season_stats", "standings")}
    got = {(r["table_name"], r["column_name"]): r for r in Q.QUERIES["p4_profile"](spark, d).collect()}
    assert set(got) == {(t, c) for t, df in tables.items() for c in df.columns}
    yards = [r[0] for r in tables["player_game_stats"].select("rushing_yards").collect()]
    row, given = got["player_game_stats", "rushing_yards"], [y for y in yards if y is not None]
    assert (row["n_rows"], row["n_null"], row["n_distinct"], row["min_number"], row["max_number"]) == (len(yards), yards.count(None), len({*given}), min(given), max(given))
    changed = {(r["table_name"], r["column_name"], r["load_id"]) for r in Q.QUERIES["p4_change"](spark, d).collect()}
    feeds = {r[0] for r in tables["player_game_stats"].select("feed").distinct().collect()}
    assert {load for t, c, load in changed if (t, c) == ("player_game_stats", "rushing_yards")} == feeds
    assert {(t, c) for t, c, _ in changed} == set(got) - {("games", "load_id"), ("standings", "load_id"), ("player_game_stats", "feed")}
