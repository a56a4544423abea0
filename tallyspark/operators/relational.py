"""Relational operators that the pipelines share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def head_and_rest(df: DataFrame, head: list[Column | str], exclude: list[str], rest: list[str | tuple[str, str]] | None = None) -> DataFrame:
    """``head`` first, then the columns of ``df`` (or ``rest``) without ``exclude``, in their order.

    An entry of ``rest`` may be a pair: the column and the name it goes by. A column of the rest whose name the head already has gets the suffix _1,
    _2 and so on, left to right, so that names stay unique.
    """
    shown = [F.col(f"`{c}`").alias(c) if isinstance(c, str) else c for c in head]
    taken = list(df.select(*shown).columns)
    for entry in rest if rest is not None else df.columns:
        column, name = entry if isinstance(entry, tuple) else (entry, entry)
        if name in exclude:
            continue
        alias, n = name, 0
        while alias in taken:
            n += 1
            alias = f"{name}_{n}"
        taken.append(alias)
        shown.append(F.col(f"`{column}`").alias(alias))
    return df.select(*shown)


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns])


def constant_view(df: DataFrame, column: str, value: object) -> DataFrame:
    """The rows whose column holds a constant; the filter reaches the scan."""
    return df.where(F.col(column) == F.lit(value))


def outside(column: str, low: float, high: float) -> Column:
    """Whether a value is out of a range; a null is in none and out of none."""
    return (F.col(column) < low) | (F.col(column) > high)


def any_null(columns: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def one_of(column: str | Column, values: tuple[str, ...]) -> Column:
    """Whether a value is in a fixed set; a null is not."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).isin(*values), F.lit(False))


def enrich(facts: DataFrame, dimension: DataFrame, prefix: str, on: list[tuple[str | Column, str]], fold: bool = False) -> DataFrame:
    """Every fact once with the columns of the dimension that it matches, under ``prefix``; null keys match nothing.

    ``on``: (fact's column, dimension's column); ``fold`` compares the last pair as names: case and blanks around don't count.
    """
    d = prefixed(dimension, prefix)
    met = []
    for n, (mine, other) in enumerate(on):
        a, b = F.col(mine) if isinstance(mine, str) else mine, F.col(f"{prefix}{other}")
        met.append(F.lower(F.trim(a)) == F.lower(F.trim(b)) if fold and n == len(on) - 1 else a == b)
    return facts.join(d, met, "left")


def distinct_counts(df: DataFrame, keys: list[str], counted: str, name: str) -> DataFrame:
    """(*keys, name): how many different values of a column each key has; the rows are aggregated before anything is joined to them."""
    return df.groupBy(*keys).agg(F.count_distinct(counted).alias(name))


def counted(df: DataFrame, by: list[str], name: str = "count") -> DataFrame:
    """How many rows each key has, the most frequent first, ties by key."""
    return df.groupBy(*by).agg(F.count("*").alias(name)).orderBy(F.desc_nulls_first(name), *by)


def percentage(condition: Column) -> Column:
    """Aggregate: of how many rows in a hundred a condition holds; null without rows."""
    return F.try_divide(100.0 * F.count_if(condition), F.count("*"))


def sides(df: DataFrame, views: list[dict[str, Column]]) -> DataFrame:
    """Each row once per view, with the view's columns: one scan, exploded, in place of a union of several. A view's column replaces one of its name."""
    seen = F.array(*[F.struct(*[e.alias(n) for n, e in view.items()]) for view in views])
    kept = [c for c in df.columns if c not in views[0]]
    return df.select(*kept, F.inline(seen))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicates once."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first by ``order``, ties by all columns, so the choice doesn't hang on partitions. Null keys are one key.

    An aggregate rather than a window: rows of one key are combined before the shuffle.
    """
    sort = [F.col(o) if isinstance(o, str) else o for o in order]
    columns = df.columns
    comparable = [c for c in columns if not isinstance(df.schema[c].dataType, T.MapType)]
    ranked = F.struct(*[o.alias(f"o{n}") for n, o in enumerate(sort)], F.struct(*comparable).alias("tie"), F.struct(*columns).alias("row")) if len(comparable) < len(columns) else F.struct(*[o.alias(f"o{n}") for n, o in enumerate(sort)], F.struct(*columns).alias("row"))
    return df.groupBy(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)]).agg(F.min(ranked).alias("m")).select("m.row.*")


def unique_mapping(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """key -> value for the keys that map to exactly one value; null keys and null values count for nothing."""
    given = df.where(" and ".join(f"`{k}` is not null" for k in keys)).where(F.col(value).isNotNull())
    # equal smallest and largest value mean one value: no distinct count needs the extra shuffle
    return given.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_last")).where(F.col(value) == F.col("_last")).drop("_last")


def attach_id(df: DataFrame, lookup: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Fills ``column`` from ``lookup`` where it is null; a row that has its id keeps it."""
    found = lookup.select(*keys, F.col(column).alias("_found"))
    base = df if column in df.columns else df.withColumn(column, F.lit(None).cast(lookup.schema[column].dataType))
    order = base.columns
    return base.join(found, keys, "left").withColumn(column, F.coalesce(column, "_found")).select(*order)


def propagate_id(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Second pass: rows without id take the one id that rows of the same key have."""
    return attach_id(df, unique_mapping(df, keys, column), keys, column)


def anti_missing(child: DataFrame, parent: DataFrame, child_keys: list[str], parent_keys: list[str], allow_null: bool = False) -> DataFrame:
    """The different keys of ``child`` that ``parent`` lacks. Null keys are missing unless ``allow_null``."""
    keys = child.select(*[F.col(c).alias(f"k{n}") for n, c in enumerate(child_keys)])
    if allow_null:
        keys = keys.dropna(how="any")
    known = parent.select(*[F.col(p).alias(f"k{n}") for n, p in enumerate(parent_keys)]).distinct()
    names = [f"k{n}" for n in range(len(child_keys))]
    return keys.distinct().join(known, names, "left_anti").toDF(*child_keys)


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that several rows have, with their number. Null keys are one key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, n_null, n_rows), all columns in one pass."""
    names = columns or df.columns
    one = df.agg(F.count("*").alias("n_rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{n}") for n, c in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("n_rows") - F.col(f"c{n}")).alias("n_null"), F.col("n_rows").alias("n_rows")) for n, c in enumerate(names)])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def last_non_null(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """One row per key: of each column the last value that isn't null, by ``order``."""
    rank = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns])


def distinct_joined(column: str, mark: str = " | ") -> Column:
    """Aggregate: the different values as one sorted text, null if there is none."""
    text = F.array_join(F.array_sort(F.collect_set(F.col(column).cast("string"))), mark)
    return F.when(text != "", text)


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key. Spark keeps n per key and partition before the shuffle."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def union_diagonal(frames: list[DataFrame]) -> DataFrame:
    """All rows under the union of all columns; a column of different types becomes text, integers and floats become doubles."""
    kinds: dict[str, set[str]] = {}
    for df in frames:
        for name, kind in df.dtypes:
            kinds.setdefault(name, set()).add(kind)

    def common(of: set[str]) -> str | None:
        of = of - {"void"}
        if len(of) < 2:
            return None
        whole = {"tinyint", "smallint", "int", "bigint"}
        return "bigint" if of <= whole else "double" if of <= whole | {"float", "double"} else "string"

    cast = {name: to for name, of in kinds.items() if (to := common(of))}
    even = [df.withColumns({c: F.col(c).cast(to) for c, to in cast.items() if c in df.columns}) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), even)


def reconcile(counts: dict[str, DataFrame], key: str) -> DataFrame:
    """Counts of several frames side by side per key, 0 where a frame lacks the key. Each frame: (key, n)."""
    tagged = [df.select(key, F.lit(name).alias("_of"), "n") for name, df in counts.items()]
    both = reduce(DataFrame.unionByName, tagged)
    return both.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col("_of") == name, F.col("n"))), F.lit(0)).cast("long").alias(name) for name in counts])


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of the row's texts, parts joined by a bar, nulls as \\N."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]), 256)
