"""Relational operators on ties, nulls and clashing names."""

from pyspark.sql import functions as F

from tallyspark.functions.stats import guarded_ratio, passer_rating
from tallyspark.operators import relational as R


def test_head_and_rest_renames_clashes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, week int, week_1 int")
    assert R.head_and_rest(df, ["a", F.lit(9).alias("week")], ["a"]).columns == ["a", "week", "week_1", "week_1_1"]


def test_keep_first_null_keys_and_ties(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("k", 1, "z"), ("k", 1, "y")], "k string, o int, v string")
    assert sorted(((r["k"] or "", r["v"]) for r in R.keep_first(df, ["k"], ["o"]).collect())) == [("", "a"), ("k", "y")]


def test_unique_mapping_and_propagation(spark):
    df = spark.createDataFrame([("a", "1"), ("a", None), ("b", "1"), ("b", "2"), (None, "3"), ("c", None)], "k string, id string")
    assert [tuple(r) for r in R.unique_mapping(df, ["k"], "id").collect()] == [("a", "1")]
    assert R.propagate_id(df, ["k"], "id").where("id is null").count() == 1


def test_anti_missing_nulls(spark):
    child, parent = spark.createDataFrame([(1,), (None,), (2,), (2,)], "c int"), spark.createDataFrame([(1,)], "p int")
    assert {r[0] for r in R.anti_missing(child, parent, ["c"], ["p"]).collect()} == {None, 2}
    assert {r[0] for r in R.anti_missing(child, parent, ["c"], ["p"], True).collect()} == {2}


def test_union_diagonal_types(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([("q", 1.5)], "x string, z double")
    assert dict(R.union_diagonal([a, b]).dtypes) == {"x": "string", "y": "int", "z": "double"}


def test_last_non_null(spark):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "b"), ("k", 3, None, None)], "k string, o int, v string, w string")
    assert R.last_non_null(df, ["k"], ["v", "w"], ["o"]).first()[1:] == ("a", "b")


def test_passer_rating(spark):
    df = spark.createDataFrame([(20.0, 13.0, 250.0, 2.0, 1.0), (20.0, 13.0, 250.0, 2.0, None), (0.0, 1.0, 1.0, 1.0, 1.0)], "a double, c double, y double, t double, i double")
    got = [r[0] and round(r[0], 4) for r in df.select(passer_rating("a", "c", "y", "t", "i")).collect()]
    assert got == [120.8333, 102.0833, None]
    assert df.select(guarded_ratio("c", "a", 100.0).alias("r")).where("r is null").count() == 1


def test_names_of_any_script_are_normalised(spark, tmp_path):
    from tallyspark.plans.operator_queries import QUERIES

    names = {"1": ("Chloé Ash", "chloe ash"), "2": ("ChloÃ© Ash", "chloa ash"), "3": ("Łucja Šťastná", "ucja stastna"), "4": ("Ann\u00a0O’Hara", "ann o hara"), "5": ("ﬁona Ｂirch", "fiona birch"), "6": ("王芳", None), "7": (None, None), "8": ("", None)}
    spark.createDataFrame([(i, n) for i, (n, _) in names.items()], "player_id string, player_name string").write.parquet(f"{tmp_path}/players.parquet")
    got = {r["player_id"]: r for r in QUERIES["normalize_name"](spark, str(tmp_path)).collect()}
    assert {i: r["normalized"] for i, r in got.items()} == {i: want for i, (_, want) in names.items()}
    assert all((r["surname"], r["initial"]) == ((w.split()[-1], w[0]) if (w := r["normalized"]) else (None, None)) for r in got.values())


def test_names_against_plain_normalisation(spark):
    """Names in any script, with ligatures, curly marks and no-break blanks: normalised as NFKD says, character by character."""
    import unicodedata

    from tallyspark.functions.people import normalised_name

    names = ["Zoë Ångström", "ﬁona O’Neil", "Ｊａｎｅ", "Łucja", "Иван", "Ann Ash-Birch", "", "…", None, "ChloÃ© ²", "x" * 3000, "Ann", "Ann"]

    def plain(name):
        if name is None:
            return None
        kept = [c for c in unicodedata.normalize("NFKD", name).lower() if not unicodedata.combining(c)]
        words = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in kept).split()
        return " ".join(words) or None

    got = [r["n"] for r in spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int").select("i", normalised_name(R.F.col("name")).alias("n")).orderBy("i").collect()]
    assert got == [plain(n) for n in names]


def test_conditions_and_views(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 9), (None, 5)], "k string, n int")

    def kept(condition):
        return [r["k"] for r in df.where(condition).collect()]

    assert kept(R.outside("n", 2, 6)) == ["a", "c"] and kept(R.any_null(["k", "n"])) == ["b", None]
    assert kept(R.one_of("k", ("a", "z"))) == ["a"] and kept(~R.one_of("k", ("a", "z"))) == ["b", "c", None]
    assert df.agg(R.percentage(R.F.col("n").isNull()).alias("p")).first()["p"] == 25.0 and df.limit(0).agg(R.percentage(R.F.col("n") > 1).alias("p")).first()["p"] is None
    both = R.sides(df.limit(1), [{"k": R.F.col("k"), "side": R.F.lit("x")}, {"k": R.F.col("n").cast("string"), "side": R.F.lit("y")}])
    assert sorted((r["k"], r["side"], r["n"]) for r in both.collect()) == [("1", "y", 1), ("a", "x", 1)]
    dim = spark.createDataFrame([(" A ", "hit"), (None, "none")], "k string, v string")
    assert [r["d_v"] for r in R.enrich(df, dim, "d_", [("k", "k")], fold=True).orderBy("n").collect() if r["d_v"]] == ["hit"]


def test_dynamic_ids(spark):
    from tallyspark.functions.documents import dynamic_ids

    texts = ['{"a": 1, "player12": " x "}', '{"player": 1}', "[1]", "{", None, '{"PLAYER7": null, "player8": "y"}']
    got = [r["x"] for r in spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int").select("i", dynamic_ids(R.F.col("t"), "player").alias("x")).orderBy("i").collect()]
    assert got == ["x", None, None, None, None, None]
