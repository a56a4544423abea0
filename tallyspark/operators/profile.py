"""Column-level data quality profile.

Method: an exact profile from unpivoted column-value counts. Every column of a
table is turned into (column, value) pairs, counted per load with map-side
combination; null shares, distinct counts, ranges, forms and the change between
loads are all aggregates of those counts. A value that a third of all rows
hold is one row after the map side; running shares are computed in two steps
over order-preserving bins, so no window holds a whole column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import join_counted, materialise

def _pieces(df: DataFrame, columns: list[str]) -> list[Column]:
    """(number of the column, cell) of each column to profile; times are counted as whole numbers, which are shorter and exact."""
    out = []
    for n, name in enumerate(columns):
        col, kind = F.col(f"`{name}`"), df.schema[name].dataType
        cell = F.unix_date(col) if isinstance(kind, T.DateType) else F.unix_micros(col.cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else col
        out.append(F.struct(F.lit(n).alias("c"), cell.cast("string").alias("cell")))
    return out


def _read(df: DataFrame, columns: list[str]) -> tuple[Column, Column]:
    """(text form, number) of a counted cell, by its column."""
    kinds = [df.schema[c].dataType for c in columns]

    def those(*of: type) -> Column:
        return F.col("c").isin([n for n, k in enumerate(kinds) if isinstance(k, of)])

    date, time = F.date_from_unix_date(F.col("cell").try_cast("int")), F.timestamp_micros(F.col("cell").try_cast("bigint"))
    text = F.when(those(T.DateType), date.cast("string")).when(those(T.TimestampType, T.TimestampNTZType), time.cast("string")).otherwise(F.col("cell"))
    number = F.when(those(T.DateType), F.unix_micros(date.cast("timestamp"))).when(those(T.NumericType, T.TimestampType, T.TimestampNTZType), F.col("cell").try_cast("double"))
    return text, number


def value_counts(df: DataFrame, table_name: str, columns: list[str], load: Column | None = None) -> DataFrame:
    """(table_name, load_id, column_name, value, number, n): how often each load holds each value. Nulls are a value.

    Without ``load`` the table is counted as a whole and there is no load_id.
    Cells cross the shuffle as a column's number and a text; what can be told
    from these is told afterwards, once per different value.
    """
    of_load = [] if load is None else ["load_id"]
    cells = df.select(*([] if load is None else [load.cast("string").alias("load_id")]), F.inline(F.array(*_pieces(df, columns))))
    text, number = _read(df, columns)
    names = F.array(*[F.lit(c) for c in columns])
    return (
        cells.groupBy(*of_load, "c", "cell").agg(F.count("*").alias("n"))
        .select(F.lit(table_name).alias("table_name"), *of_load, F.get(names, F.col("c")).alias("column_name"), text.alias("value"), number.alias("number"), "n")
    )


def load_sizes(df: DataFrame, table_name: str, columns: list[str], load: Column) -> DataFrame:
    """(table_name, load_id, column_name, n): the rows of each load, once for each column."""
    rows = df.groupBy(load.cast("string").alias("load_id")).agg(F.count("*").alias("n"))
    return rows.select(F.lit(table_name).alias("table_name"), "load_id", F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"), "n")


def form_of(value: Column) -> Column:
    """The form of a text: digits 9, letters a, runs collapsed."""
    shape = F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), r"[0-9]+", "9")
    return F.regexp_replace(shape, r"\s+", " ")


def column_profile(counts: DataFrame) -> DataFrame:
    """One row per table and column, over all loads, from ``value_counts``.

    An empty table gives no rows; an all-null column has null range and form.
    Ties between forms go to the smaller form. ``n_off_form`` counts the values
    that break the pattern most values of the column have, ``off_form_share``
    is their share of the values given.
    """
    keys = ["table_name", "column_name"]
    values = counts.groupBy(*keys, "value", "number").agg(F.sum("n").alias("n")) if "load_id" in counts.columns else counts
    forms = (
        values.where("value is not null").groupBy(*keys, form_of(F.col("value")).alias("form")).agg(F.sum("n").alias("n"))
        .groupBy(*keys).agg(F.max_by("form", F.struct("n", F.col("form"))).alias("main_form"), F.count("*").alias("n_forms"), F.max("n").alias("n_main_form"))
    )
    given = F.col("n_rows") - F.col("n_null")
    return (
        values.groupBy(*keys).agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
            F.count("value").alias("n_distinct"),
            F.min("value").alias("min_text"), F.max("value").alias("max_text"),
            F.min("number").alias("min_number"), F.max("number").alias("max_number"),
        )
        .join(forms, keys, "left")
        .withColumns({"null_share": F.col("n_null") / F.col("n_rows"), "n_off_form": given - F.coalesce("n_main_form", F.lit(0))})
        .withColumn("off_form_share", F.when(given > 0, F.col("n_off_form") / given))
    )


def population_stability(counts: DataFrame, sizes: DataFrame | None = None, floor: float = 1e-4) -> DataFrame:
    """Population stability index and chi-square of each load against all other loads of the table.

    Both run over all values of the table (null is one), those the load lacks
    too; in the index a share below ``floor`` counts as ``floor``.
    A load that is the only one of its table has null figures. ``sizes``, from
    ``load_sizes``, spares telling the rows of each load from the counts, which
    takes a second pass over them.

    The counts cross one more shuffle, by value, which brings a value's loads
    together for its total; all else is of the size of loads and columns.
    """
    keys = ["table_name", "column_name"]
    load = F.coalesce(F.concat(F.lit("="), F.col("load_id")), F.lit(""))
    value = Window.partitionBy(*keys, "v")
    by_value = counts.select(*keys, load.alias("load"), F.coalesce(F.concat(F.lit("="), F.col("value")), F.lit("")).alias("v"), "n")
    # one row of each value stands for it: both uses below read the same shuffled rows
    held = by_value.withColumns({"n_all": F.sum("n").over(value), "stands": F.col("load") == F.min("load").over(value)}).drop("v")
    loads = materialise((counts if sizes is None else sizes).groupBy(*keys, load.alias("load")).agg(F.sum("n").alias("n_load")))
    sizes = materialise(loads.join(loads.groupBy(*keys).agg(F.sum("n_load").alias("n_table")), keys))
    rest = F.col("n_table") - F.col("n_load")
    # a value a load lacks adds a term in its total alone: the terms of all values, by how many have a total, less those of the held ones
    q_lacked = F.greatest(F.col("n_all") / rest, F.lit(floor))
    lacked = (F.lit(floor) - q_lacked) * F.log(F.lit(floor) / q_lacked)
    alike = held.where("stands").groupBy(*keys, "n_all").agg(F.count("*").alias("n_values"))
    whole = sizes.where(rest > 0).join(alike, keys).groupBy(*keys, "load").agg(F.sum(F.col("n_values") * lacked).alias("psi_if_lacked"))
    p = F.greatest(F.col("n") / F.col("n_load"), F.lit(floor))
    q = F.greatest((F.col("n_all") - F.col("n")) / rest, F.lit(floor))
    expected = F.col("n_all") * F.col("n_load") / F.col("n_table")
    expected_rest = F.col("n_all") * rest / F.col("n_table")
    chi = (F.col("n") - expected) ** 2 / expected + (F.col("n_all") - F.col("n") - expected_rest) ** 2 / expected_rest
    return (
        join_counted(held, sizes, [*keys, "load"]).where(rest > 0).groupBy(*keys, "load")
        .agg(F.sum((p - q) * F.log(p / q) - lacked).alias("psi"), F.sum(chi).alias("chi_square"), F.first("n_load").alias("n_load"), F.sum("n_all").alias("n_held"), F.first("n_table").alias("n_table"))
        .join(whole, [*keys, "load"])
        .withColumn("psi", F.col("psi") + F.col("psi_if_lacked"))
        # a value absent from the load adds n_all * n_load / n_table * (1 + n_load / (n_table - n_load)) to chi-square
        .withColumn("chi_square", F.col("chi_square") + (F.col("n_table") - F.col("n_held")) * F.col("n_load") / (F.col("n_table") - F.col("n_load")))
        .select(*keys, F.when(F.col("load") != "", F.expr("substring(load, 2)")).alias("load_id"), "n_load", "psi", "chi_square")
    )


def _sortable(number: Column, bits: int) -> Column:
    """A bin that keeps the order of doubles; NaN is the largest, as Spark sorts it. Order within a bin is left to the value."""
    squashed = F.signum(number) * F.least(F.log1p(F.abs(number)), F.lit(720.0))
    return F.when(F.isnan(number), F.lit(721 << 20)).otherwise(F.floor(squashed * F.lit(2.0**bits))).cast("long")


def running_counts(counts: DataFrame, by: list[str], bits: int = 6) -> DataFrame:
    """``counts`` with ``upto``: the sum of n over the numbers not above the row's, per ``by``.

    Two steps: totals of order-preserving bins are run first, then the values
    of one bin, so the rows of a column are never sorted as one partition.
    """
    binned = counts.withColumn("bin", _sortable(F.col("number"), bits))
    bins = binned.groupBy(*by, "bin").agg(F.sum("n").alias("in_bin"))
    before = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("below", F.coalesce(F.sum("in_bin").over(before), F.lit(0))).drop("in_bin")
    inside = Window.partitionBy(*by, "bin").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    return binned.withColumn("run", F.sum("n").over(inside)).join(bins, [*by, "bin"]).withColumn("upto", F.col("run") + F.col("below")).drop("run", "below", "bin")


def failed_loads(counts: DataFrame, ranges: dict[tuple[str, str], tuple[float, float]]) -> DataFrame:
    """(table_name, load_id, column_name) of the loads in which a column of ``ranges`` has gone wrong.

    A load fails if 20 % or more of its values are null, 10 % or more of the
    others out of range, fewer than three of them differ, or its distribution
    function departs by 0.45 or more from that of all other loads together.
    All tests are in whole numbers, so equality at a limit is exact. A load
    whose values are all null fails by its nulls; the only load of a table has
    nothing to depart from. Rows without a load_id form one load.
    """
    keys = ["table_name", "column_name"]
    spark = counts.sparkSession
    limits = F.broadcast(spark.createDataFrame([(t, c, float(lo), float(hi)) for (t, c), (lo, hi) in ranges.items()], "table_name string, column_name string, lo double, hi double"))
    own = counts.join(limits, keys).withColumn("load_id", F.coalesce("load_id", F.lit("")))
    given = own.where("number is not null").groupBy(*keys, "load_id", "number").agg(F.sum("n").alias("n"))
    outside = F.col("number").isNotNull() & ((F.col("number") < F.col("lo")) | (F.col("number") > F.col("hi")) | F.isnan("number"))
    loads = own.groupBy(*keys, "load_id").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("number").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outside"),
        F.count_distinct("number").alias("different"),
    )
    filled = F.col("rows") - F.col("nulls")
    whole = given.groupBy(*keys, "number").agg(F.sum("n").alias("n"))
    upto = running_counts(whole, keys).select(*keys, "number", F.col("upto").alias("all_upto"), (F.col("upto") - F.col("n")).alias("all_below"))
    of_load = running_counts(given, [*keys, "load_id"]).select(*keys, "load_id", "number", F.col("upto").alias("own_upto"), (F.col("upto") - F.col("n")).alias("own_below"))
    sizes = given.groupBy(*keys, "load_id").agg(F.sum("n").alias("own_n"))
    totals = given.groupBy(*keys).agg(F.sum("n").alias("all_n"))

    def gap(own_part: str, all_part: str) -> Column:
        rest_n = F.col("all_n") - F.col("own_n")
        return F.abs(F.col(own_part) * rest_n - (F.col(all_part) - F.col(own_part)) * F.col("own_n")) * 20 >= rest_n * F.col("own_n") * 9

    # between two values of a load its own share stands still, so its departure is largest at one of them or just below the next
    departs = (
        of_load.join(upto, [*keys, "number"]).join(sizes, [*keys, "load_id"]).join(totals, keys)
        .where("all_n > own_n").groupBy(*keys, "load_id")
        .agg(F.max(gap("own_upto", "all_upto") | gap("own_below", "all_below")).alias("departs"))
    )
    return (
        loads.join(departs, [*keys, "load_id"], "left")
        .where((F.col("nulls") * 5 >= F.col("rows")) | ((F.col("outside") * 10 >= filled) & (filled > 0)) | (F.col("different") < 3) | F.coalesce("departs", F.lit(False)))
        .select("table_name", "load_id", "column_name")
    )
