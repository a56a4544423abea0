"""Orphan references: intervals, typed ids, skew, empty sides."""

from datetime import datetime

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.operators import references as R

DAY = [datetime(2020, 1, d) for d in range(1, 29)]
STATS = "row_id long, season long, league string, player_id string, loaded_at timestamp"
PLAYERS = "player_id string, loaded_at timestamp, deleted_at timestamp"


def orphans(spark, rows, parents, **options):
    key = R.id_key("player_id")
    refs = R.reference_rows(spark.createDataFrame(rows, STATS), "t", "player", key, [key])
    known = R.parent_records(spark.createDataFrame(parents, PLAYERS), "player", [key])
    return sorted(r["row_id"] for r in R.orphan_references(refs, known, **options).collect())


def test_in_force(spark):
    parents = [("p1", DAY[5], None), (" P2 ", DAY[1], DAY[10]), ("P2", DAY[12], None), ("P3", None, None), (None, DAY[0], None), ("P4", DAY[1], DAY[3]), ("P4", DAY[2], DAY[20]), ("P4", DAY[2], DAY[20])]
    rows = [
        (1, 2020, "a", "P1", DAY[5]), (2, 2020, "a", "P1", DAY[4]), (3, 2020, "a", " p2", DAY[9]), (4, 2020, "a", "P2", DAY[10]), (5, 2020, "a", "P2", DAY[13]),
        (6, 2020, "a", "P3", DAY[9]), (7, 2020, "a", "NR", DAY[9]), (8, 2020, "a", " - ", DAY[9]), (9, 2020, "a", None, DAY[9]), (10, 2020, "a", "P9", DAY[9]),
        (11, None, None, "P1", None), (12, 2020, "a", "P4", DAY[5]), (12, 2020, "a", "P4", DAY[5]), (13, 2020, "a", "x" * 500, DAY[5]), (10, 2020, "a", "P9", DAY[9]),
    ]
    assert orphans(spark, rows, parents) == [2, 4, 6, 10, 10, 11, 13]
    # one range, tiny batches: a hot key is dealt over many of them
    assert orphans(spark, rows, parents, ranges=1, batch_rows=2) == [2, 4, 6, 10, 10, 11, 13]


def test_copies_of_parents_grow_with_them(spark):
    """Ten times the references to ten times the parents, one parent a third of them: ten times the copies, about, not a hundred times."""
    copies = []
    for n in (2_000, 20_000):
        refs = spark.range(n).selectExpr("case when id % 3 = 0 then 'hot' else concat('k', id % {0}) end as key".format(n // 10), "id as row_id", "'t' as table_name", "2020L as season", "1L as at")
        parents = spark.range(n // 10).selectExpr("concat('k', id) as key", "0L as start", "9L as end")
        dealt, known = R.deal(refs, parents, batch_rows=200)
        assert dealt.count() == n
        copies.append(known.count())
    assert copies[1] < 15 * copies[0]


def test_empty_sides(spark):
    rows = [(1, 2020, "a", "P1", DAY[5])]
    assert orphans(spark, rows, []) == [1]
    assert orphans(spark, [], [("P1", DAY[0], None)]) == []


def test_scoped_keys_and_clashing_columns(spark):
    teams = spark.createDataFrame([("l", 2020, "t1", DAY[0], None, "x")], "league string, season long, team_id string, loaded_at timestamp, deleted_at timestamp, key string")
    tss = spark.createDataFrame([(1, "l", 2020, "T1", DAY[1], "y"), (2, "l", 2021, "T1", DAY[1], "y"), (3, None, 2020, "T1", DAY[1], "y")], "row_id long, league string, season long, team_id string, loaded_at timestamp, g string")
    parts = [R.F.col("league"), R.F.col("season"), R.id_key("team_id")]
    found = R.orphan_references(R.reference_rows(tss, "tss", "team", R.id_key("team_id"), parts), R.parent_records(teams, "team", parts))
    assert sorted(r["row_id"] for r in found.collect()) == [2, 3]
    assert {(r["season"], r["n_orphans"]) for r in R.orphan_report(found).collect()} == {(2021, 1), (2020, 1)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 9), st.integers(0, 9)), max_size=12), st.lists(st.tuples(st.sampled_from("abcd"), st.integers(-1, 10)), min_size=1, max_size=12))
def test_probe_against_brute_force(parents, refs):
    keys = np.array([p[0].encode() for p in parents], dtype="S1")
    start, end = (np.array([p[n] for p in parents], dtype=np.int64) for n in (1, 2))
    got = R.probe_sorted(keys, start, end, np.array([r[0].encode() for r in refs], dtype="S1"), np.array([r[1] for r in refs], dtype=np.int64))
    assert got.tolist() == [any(k == p[0] and p[1] <= t < p[2] for p in parents) for k, t in refs]
