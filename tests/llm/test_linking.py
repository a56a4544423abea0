"""Names, spellings, keyless matches and survivors on small fixtures."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

names = pytest.importorskip("tallyspark.llm.names")
from tallyspark.llm import components, matching, spellings, survivors  # noqa: E402

T0 = datetime(2020, 1, 1)


def plain_edits(a, b):
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7), st.integers(0, 4))
def test_edits_against_brute_force(a, b, most):
    assert names.edits(a, b, most) == min(plain_edits(a, b), most + 1)


@settings(max_examples=100, deadline=None)
@given(st.text("abcd", min_size=3, max_size=8), st.integers(0, 7), st.sampled_from("abcd"))
def test_one_edit_meets_in_the_delete_index(token, at, letter):
    at %= len(token)
    for other in (token[:at] + token[at + 1 :], token[:at] + letter + token[at:], token[:at] + letter + token[at + 1 :]):
        if len(other) > 2:
            assert spellings.deletes(token) & spellings.deletes(other)


@pytest.mark.parametrize(
    ("a", "b", "alike"),
    [
        ("RenÃ©e Praastine", "Renée Praastine", True), ("PETESTRAND Susannah", "Petestrand, Susannah M.", True), ("J. Damandra", "Jessica Damandra", True), ("Lizzie Abeulova", "Elizabeth T. Abeulova", True),
        ("BriannaQueetz", "Brianna Queetz", True), ("Wi1helmina Olseschen", "Wilhelmina Olseschen", True), ("Deborah Velinsky", "Deborah Velinsky-Queeschen", True), ("Theresa (Tess) Kleashvili", "Theresa Kleashvili-Croinsky", True),
        ("Quinn Dreashvili", "Monique Dreashvili", False), ("Jacqueline D. Croetz", "Jacqueline Daminsky", False), ("N. Bilamante", "Gwen Bilamante", False), ("", "Ann Ash", False), ("…", "…", False),
    ],
)
def test_name_likeness(a, b, alike):
    assert (names.name_likeness(a, b)[0] > 0.5) == alike == (names.name_likeness(b, a)[0] > 0.5)


def test_common_words_are_no_typing_errors():
    assert names.name_likeness("Kara Noro", "Zara Noro")[0] > 0 == names.name_likeness("Kara Noro", "Zara Noro", ("kara", "zara"))[0]


@pytest.mark.parametrize(("text", "value"), [("5-4", 64), ("5'11\"", 71), ("5-04", 64), ("66", 66), ("168 cm", 66), ("NR", None), (None, None), ("0", None)])
def test_heights(text, value):
    assert spellings.inches(text) == value


def test_weights():
    assert [spellings.pounds(x) for x in ("166", "129 lbs", "151lb", "0", None, "70 kg")] == [166, 129, 151, None, None, 154]


PLAYERS = "player_id string, player_name string, height string, weight string, school string, hometown string, loaded_at timestamp, deleted_at timestamp, person string"


def player(i, name, height="5-4", weight="150", school="Oak High School", town="Elm Bay"):
    return (i, name, height, weight, school, town, T0, None, "clash")


def found(spark, rows):
    out = spellings.pairs_of_classes(spellings.link_spellings(spark.createDataFrame(rows, PLAYERS)))
    return sorted(tuple(r) for r in out.collect())


def test_spellings(spark):
    rows = [
        player("P1", "Charlotte Damerby"), player(" p1 ", "Charlotte Damerby"), player("P2", "DAMERBY, Charlote", "64", "152lb", "Oak HS", "ELM BAY"), player("P3", "Lottie Damerby-Stone", "5'5\"", None, "Oak High School", "Elm Bay, WFA region"),
        player("P4", "Charlotte Damerby", "6-0", "220"), player("P5", "Susan Damerby"), player("P6", None), player("P7", "-"), player(None, "Charlotte Damerby"), player("PTEAM", "TEAM"),
        player("P8", "Charlotte Damerby", None, None, None, None), player("P9", "x" * 5000), player("P10", "C. Damerby", "5-4", "151"),
    ]
    want = ["P1", "P10", "P2", "P3"]
    assert found(spark, rows) == [(a, b) for a in want for b in want if a < b]


def test_spellings_copies_and_empty(spark):
    assert found(spark, [player("A", "Ann Ash"), player("B", "Ann Ash"), player("C", "Ann Ash")]) == [("A", "B"), ("A", "C"), ("B", "C")]
    assert found(spark, []) == []


def test_copies_that_give_less(spark):
    rows = [player(i, "Ann Ash", school=None) for i in "AB"] + [player("C", "Ann Ash", weight="151", school=None)]
    rows += [player(i, "Zoe Birch", None, None, town="Fir") for i in "DE"] + [player(i, "Ida Elder", None, None, None, town="Yew") for i in "FG"] + [player(i, "Una Larch", "6-0", "190", None, None) for i in "HI"]
    rows += [player(i, "Sky", town="Ivy") for i in "LM"]
    assert found(spark, rows) == [("A", "B"), ("A", "C"), ("B", "C"), ("D", "E"), ("F", "G"), ("L", "M")]


def test_classes_of_a_long_chain(spark):
    links = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(70)] + [("z1", "z2"), ("z2", "z1"), ("q", "q")], "a string, b string")
    got = {r["id"]: r["class_id"] for r in components.linked_classes(links).collect()}
    assert len(got) == 73 and set(got.values()) == {"n000", "z1"}


STATS = "row_id long, league string, season long, game_id string, team_id string, team_name string, source_player_id string, player_name string, roster_number string, player_id string, rushing_yards double, receiving_yards double, tackles_combined double, total_points double, feed string, loaded_at timestamp, trust_rank int, trusted string"


def line(i, feed, day, name="Ann Ash", number="7", yards=1.0, game="g", player="p", source="s", team="t", team_name="Ants"):
    return (i, "l", 2020, game, team, team_name, source, name, number, player, yards, None, 2.0, 3.0, feed, datetime(2020, 1, day) if day else None, 5, "clash")


def survived(spark, rows, trust=(("good", 1), ("bad", 2), ("bad", 3), (None, 0))):
    out = survivors.game_line_survivors(spark.createDataFrame(rows, STATS), spark.createDataFrame(list(trust), "feed string, trust_rank int"))
    return sorted((r["group_row_id"], r["field_name"], r["source_row_id"]) for r in out.collect())


def test_survivors(spark):
    rows = [
        line(5, "bad", 9, "Ann  Ash"), line(4, "good", 2, None, "NR", None), line(3, "good", 1, "A. Ash", "-", 4.0), line(2, "unknown", 9), line(6, "good", 2, " A. Ash ", None, None), line(6, "good", 2, " A. Ash ", None, None),
        line(7, "bad", 1, game=" G ", player="P "), line(8, "good", None, "Z", "9", 9.0), line(9, "good", 1, game="h"), line(10, "good", 1, game=None), line(11, "good", 1, game=None),
    ]
    assert survived(spark, rows) == [(2, "player_name", 6), (2, "roster_number", 8), (2, "rushing_yards", 3), (2, "tackles_combined", 4), (2, "total_points", 4)]
    assert survived(spark, []) == []


def test_survivors_of_a_group_with_many_values(spark):
    rows = [line(i, "bad" if i else "good", 1 + i % 20, f"Name {i}", str(i), float(i)) for i in range(900)]
    assert {s for _, _, s in survived(spark, rows)} == {0}


def test_consensus_by_votes():
    values = ["Ann Marie Ash", "Ann Marie Ash-Birch", "Anne Marie Ash", "Zoe"]
    assert values[survivors.consensus(values, [1, 1, 1, 1])] == "Ann Marie Ash"
    assert survivors.consensus(values, [1, 1, 9, 1]) == 2 and survivors.consensus(values, survivors._weights([1] * 4, True)) == 0
    assert survivors.consensus(["x"], [1]) == 0 and survivors.consensus(["", "a"], [2, 1]) == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab -", max_size=8), min_size=1, max_size=6, unique=True))
def test_rank_weights_choose_the_first(values):
    assert survivors.consensus(values, survivors._weights([1] * len(values), True)) == 0


def test_matches(spark):
    people = [("P1", "Elizabeth Ash"), ("P2", "Zara Birch"), ("P3", "Susan Ash"), ("P4", None)]
    players = spark.createDataFrame([(*p, "clash") for p in people], "player_id string, player_name string, name string")
    roster = [("l", 2020, " T", "Ants", p, n) for p, n in (("P1", "7"), ("P2", "#09"), ("P3", None), ("P4", "44"))]
    rosters = spark.createDataFrame(roster, "league string, season long, team_id string, team_name string, player_id string, roster_number string")
    rows = [
        line(1, "f", 1, "Liz Ash", "07", player="-", source="S1"), line(2, "f", 1, "ASH, E.", None, player=None, source="s1 "), line(3, "f", 1, "Zara Brich", "9", player=None, source="S2", team=None, team_name=" ants"),
        line(4, "f", 1, "Paula Quent", "13", player=None, source="S3"), line(5, "f", 1, None, None, player=None, source="S4"), line(6, "f", 1, "Zara Birch", "9", player="P2", source="S5"), line(7, "f", 1, "Zara Birch", "9", player=None, source="S5"),
        line(8, "f", 1, "Zara Birch", "9", player=None, source="S6", team="other"), line(9, "f", 1, "Zara Birch", "9", player=None, source=None), line(10, "f", 1, "TEAM", None, player="PTEAM", source="STEAM"),
    ]
    got = matching.SourceMatches(spark.createDataFrame(rows, STATS), rosters, players).best()
    assert {(r["source_player_id"], r["player_id"]) for r in got.collect()} == {("S1", "P1"), ("S2", "P2")}
    empty = matching.SourceMatches(spark.createDataFrame([], STATS), rosters.limit(0), players.limit(0)).best()
    assert empty.count() == 0


def test_model_learns_and_calibrates():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((4000, len(matching.FEATURES)))
    y = (x[:, 0] + x[:, 5] + rng.normal(0, 0.2, 4000) > 1).astype(float)
    held = np.arange(4000) % 5 == 0
    m = matching.fit_model(x, y, held)
    score = np.hstack([(x - m.mean) / m.scale, np.ones((4000, 1))]) @ m.weights
    p = 1 / (1 + np.exp(-(score * m.slope + m.offset)))
    assert ((p > 0.5) == (y > 0.5))[held].mean() > 0.85
    assert abs(p[held].mean() - y[held].mean()) < 0.03


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["ann", "anne", "lee", "leigh", "x", "j", "marie", "mary"]), min_size=9, max_size=11), st.lists(st.sampled_from(["ann", "lee", "j", "marie", "q"]), min_size=9, max_size=11))
def test_long_names_are_assigned_as_well_as_short_ones(a, b):
    """The sum of likenesses equals that of the table over all subsets that short names use."""

    def best(rows):
        sums = {0: 0.0}
        for x in rows:
            step = dict(sums)
            for used, total in sums.items():
                for j, y in enumerate(b):
                    if not used >> j & 1:
                        step[used | 1 << j] = max(step.get(used | 1 << j, -1.0), total + names.token_likeness(x, y))
            sums = step
        return max(sums.values())

    pairs = names.align(tuple(a), tuple(b))
    assert len({i for i, _, _ in pairs}) == len({j for _, j, _ in pairs}) == len(pairs)
    assert sum(s for _, _, s in pairs) == pytest.approx(best(a))


def test_names_of_many_words_and_letters():
    words = [f"word{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(300)]
    assert names.name_likeness(" ".join(words), " ".join(reversed(words)))[0] == 1.0
    assert names.name_likeness(" ".join(words), " ".join(words[:-1] + ["other", "thing"]))[0] == 0.0
    assert names.name_likeness("x" * 20_000 + " Ash", "x" * 19_999 + "y Ash")[0] > 0.5


def test_hot_towns_and_names_are_narrowed_alike(spark):
    """A town with a third of all persons, half of them of one first name: whatever the bound, the same links."""
    first, second = ["Jane", "Jane", "Jane", "Carla", "Nora"], ["Ash", "Birch", "Cedar", "Damson", "Elder", "Fir", "Gorse", "Hazel"]
    rows = []
    for n in range(160):
        town = "Elm Bay" if n % 3 else f"Town {chr(97 + n % 20)}"
        name = f"{first[n % 5]} {second[n % 8]}{'son' if n % 7 == 0 else ''}"
        rows.append(player(f"P{n:03}", name, None if n % 11 == 0 else f"5-{n % 12}", None if n % 13 == 0 else str(120 + n % 40), None if n % 4 else "Oak High School", town))
        if n % 6 == 0:
            rows.append(player(f"Q{n:03}", name[:2] + name[3:] if n % 12 else f"{name[0]}. {name.split()[1]}", rows[-1][2], rows[-1][3], rows[-1][4], town))
    df = spark.createDataFrame(rows, PLAYERS)
    want = sorted(tuple(r) for r in spellings.pairs_of_classes(spellings.link_spellings(df)).collect())
    assert len(want) > 20
    for most in (40, 12, 3):
        assert sorted(tuple(r) for r in spellings.pairs_of_classes(spellings.link_spellings(df, most)).collect()) == want


def test_the_bound_of_a_key_loses_no_link(spark):
    """Surnames with both first letters mistyped, and a name run together with a slip: found in a town of many as in one of few."""
    names = ["Jane Smithson", "Jane Xkithson", "Jane Brook", "janeook", "Jane Underwood", "Jane Mulberry", "Jane Gooseberry", "Jane Damson"]
    rows = [player(f"P{n}", name, None if n == 2 else "5-4", "150", None) for n, name in enumerate(names)]
    df = spark.createDataFrame(rows, PLAYERS)
    for most in (2_000, 6, 3, 2):
        got = spellings.pairs_of_classes(spellings.link_spellings(df, most)).collect()
        assert sorted(tuple(r) for r in got) == [("P0", "P1"), ("P2", "P3")], most


def test_a_copy_keeps_the_links_of_its_representative(spark):
    rows = [player("P1", "Johnsonash", school=None), player("P2", "Johnsonash", school=None), player("P3", "Johnson Ash", weight="151", school=None)]
    assert found(spark, rows) == [("P1", "P2"), ("P1", "P3"), ("P2", "P3")]


def test_spellings_of_persons(spark):
    classes = spark.createDataFrame([("P1", "P1"), ("P2", "P1")], "person string, class_id string")
    kinds = "player_id string, player_name string, n string"
    players = spark.createDataFrame([("P1", "Ann Ash", "x"), ("P2", "ASH, Ann", "x"), ("P3", "Bea Birch", "x"), (None, "Ann Ash", "x"), ("PTEAM", "TEAM", "x"), ("P4", None, "x")], kinds)
    lines = spark.createDataFrame([(" p1 ", "A. Ash", "x")] * 3 + [("p2", "Ann Ash", "x"), ("P1", "Zoe Zorn", "x"), ("P1", "NR", "x")], kinds)
    got = {(r["person"], r["spelling"]): r for r in spellings.spellings_of_persons(classes, {"players": players, "lines": lines}).collect()}
    assert set(got) == {("P1", "Ann Ash"), ("P1", "ASH, Ann"), ("P1", "A. Ash"), ("P1", "Zoe Zorn"), ("P3", "Bea Birch")}
    assert {r["main_spelling"] for (p, _), r in got.items() if p == "P1"} == {"Ann Ash"}
    assert (got["P1", "A. Ash"]["n_players"], got["P1", "A. Ash"]["n_lines"], got["P1", "Ann Ash"]["n_lines"]) == (0, 3, 1)
    assert {k[1] for k, r in got.items() if not r["agrees"]} == {"Zoe Zorn"}
    assert spellings.spellings_of_persons(classes.limit(0), {"players": players.limit(0)}).count() == 0


def test_votes_decide_where_rank_does_not(spark):
    """Three lines against the one of the most trusted feed: by rank the one, by votes the three; against a plain count."""
    rows = [line(1, "good", 9, "A. Ash", "7", 9.0), line(2, "bad", 1, "Ann Ash", "17", 4.0), line(3, "bad", 2, "Ann Ash", "17", 4.0), line(4, "bad", 3, "Ann  Ash", "17", None)]
    stats, trust = spark.createDataFrame(rows, STATS), spark.createDataFrame([("good", 1), ("bad", 2)], "feed string, trust_rank int")
    ranked = {r["field_name"]: r["source_row_id"] for r in survivors.game_line_survivors(stats, trust).collect()}
    voted = {r["field_name"]: r["value"] for r in survivors.game_line_survivors(stats, trust, by_rank=False).collect()}
    assert ranked["player_name"] == ranked["roster_number"] == ranked["rushing_yards"] == 1
    assert (voted["player_name"], voted["roster_number"], voted["rushing_yards"]) == ("Ann Ash", "17", "4.0")


def test_rank_takes_no_vote(spark, monkeypatch):
    """By rank nothing is aligned or voted on and nothing is written in between; by votes it is."""
    rows = [line(1, "good", 9, "A. Ash"), line(2, "bad", 1, "Ann Ash"), line(3, "bad", 2, "Ann Ash")]
    stats, trust = spark.createDataFrame(rows, STATS), spark.createDataFrame([("good", 1), ("bad", 2)], "feed string, trust_rank int")
    written = []
    monkeypatch.setattr(survivors, "materialise", lambda df: written.append(df) or df)
    plans = {by_rank: survivors.game_line_survivors(stats, trust, by_rank)._jdf.queryExecution().optimizedPlan().toString() for by_rank in (False, True)}
    assert "ArrowEvalPython" in plans[False] and len(written) == 1
    assert "Python" not in plans[True]
