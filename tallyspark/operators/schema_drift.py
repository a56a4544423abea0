"""Schemas that drift between files.

Method: every record becomes a list of (path, raw type, value); statistics of
paths and types are aggregated by file; files of a stream are compared with the
one before; the table of a feed is projected with typed columns, and values
that fail their cast are reported. A rename is a field that stops and another
that starts in the same file with the same type, whose names never stand side
by side in a file of the stream and whose contents agree.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import NULL_TOKENS
from ..session import join_counted, materialise, ship

KINDS = ("text", "boolean", "decimal", "integer")
_CELL = "array<struct<name:string,kind:string,value:string>>"
CELLS = f"row_id long, stream_id string, feed string, league string, file_id string, as_of timestamp, delivered_at timestamp, rec_no int, parsed boolean, cells {_CELL}"


def clean_key(key: str) -> str:
    """Lower case; blanks and hyphens to one underscore, none at the ends."""
    return re.sub(r"_+", "_", re.sub(r"[\s-]", "_", key.strip().lower())).strip("_")


class _Number(str):
    """A JSON number as written."""


def _cells(value: object, path: str, out: dict[str, tuple[str, str | None]]) -> None:
    if isinstance(value, dict):
        for key, inner in value.items():
            name = clean_key(key)
            _cells(inner, f"{path}.{name}" if path else name, out)
    elif value is None:
        out[path] = ("null", None)
    elif isinstance(value, bool):
        out[path] = ("boolean", "true" if value else "false")
    elif isinstance(value, _Number):
        out[path] = ("decimal" if "." in value else "integer", str(value))
    elif isinstance(value, str):
        out[path] = ("null", None) if value.strip() in NULL_TOKENS else ("text", value)
    else:
        out[path] = ("text", json.dumps(value, ensure_ascii=False))


def record_cells(payload: str | None) -> list[dict[str, str | None]] | None:
    """The (path, raw type, value) cells of a JSON object; null if it isn't one. Of keys that clean to one name the last wins."""
    try:
        value = json.loads(payload or "", parse_int=_Number, parse_float=_Number, parse_constant=_Number)
    except (ValueError, RecursionError):
        return None
    if not isinstance(value, dict):
        return None
    out: dict[str, tuple[str, str | None]] = {}
    _cells(value, "", out)
    return [{"name": k, "kind": kind, "value": v} for k, (kind, v) in out.items()]


def load_cells(feed_rows: DataFrame) -> DataFrame:
    """feed_rows with ``cells`` in place of the payload; ``parsed`` is false where the payload is no JSON object."""
    keep = [f for f in CELLS.split(", ") if not f.startswith(("parsed", "cells"))]
    kinds = pa.list_(pa.struct([("name", pa.string()), ("kind", pa.string()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [record_cells(x) for x in batch.column("payload").to_pylist()]
            columns = [c for c in batch.schema.names if c != "payload"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array([c is not None for c in cells]), pa.array(cells, kinds)], [*columns, "parsed", "cells"]
            )

    ship(feed_rows.sparkSession)
    narrow = feed_rows.selectExpr(*(f"cast({f.split()[0]} as {f.split()[1]}) {f.split()[0]}" for f in keep), "payload")
    return narrow.mapInArrow(run, CELLS)


def field_statistics(cells: DataFrame) -> DataFrame:
    """One row per file and field: how many records have it, and its values of each raw type."""
    flat = cells.where("parsed and file_id is not null").select("feed", "stream_id", "file_id", "as_of", F.explode("cells").alias("c")).select("feed", "stream_id", "file_id", "as_of", "c.name", "c.kind")
    return flat.groupBy("feed", "stream_id", "file_id", "as_of", "name").agg(
        F.count("*").alias("n_records"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS]
    ).withColumn("type", _type_of())


def _type_of() -> Column:
    kind = F.when(F.col("n_text") > 0, "text").when(F.col("n_boolean") > 0, "boolean")
    return kind.when(F.col("n_decimal") > 0, "decimal").when(F.col("n_integer") > 0, "integer")


def file_steps(cells: DataFrame) -> DataFrame:
    """(feed, stream_id, file_id, file_no): the files of each stream in the order of as_of, then file_id."""
    files = cells.where("file_id is not null").groupBy("feed", "stream_id", "file_id").agg(F.min("as_of").alias("as_of"))
    return files.withColumn("file_no", F.row_number().over(Window.partitionBy("feed", "stream_id").orderBy("as_of", "file_id")))


def field_steps(statistics: DataFrame, files: DataFrame) -> DataFrame:
    """One row per file (but the first) and field that it or the file before has: its type in either, and whether it is there."""
    keys = ["feed", "stream_id", "file_id"]
    numbered = statistics.groupBy(*keys, "name").agg(*[F.sum(f"n_{k}").alias(f"n_{k}") for k in KINDS]).withColumn("type", _type_of()).join(files.select(*keys, "file_no"), keys)
    here = numbered.select("feed", "stream_id", "file_no", "name", F.lit(True).alias("here"), F.lit(False).alias("before"), F.col("type").alias("new_type"), F.lit(None).cast("string").alias("old_type"))
    then = numbered.select("feed", "stream_id", (F.col("file_no") + 1).alias("file_no"), "name", F.lit(False).alias("here"), F.lit(True).alias("before"), F.lit(None).cast("string").alias("new_type"), F.col("type").alias("old_type"))
    steps = here.unionByName(then).groupBy("feed", "stream_id", "file_no", "name").agg(F.max("here").alias("here"), F.max("before").alias("before"), F.max("new_type").alias("new_type"), F.max("old_type").alias("old_type"))
    return steps.join(files.select("feed", "stream_id", "file_no", "file_id"), ["feed", "stream_id", "file_no"]).where("file_no > 1")


def _content(cells: DataFrame, names: DataFrame) -> DataFrame:
    """(feed, name, item, n): what the fields ``names`` (feed, name) hold, as counts of items; other fields are left aside before they are taken apart.

    An item is a bin of a number (on a scale that widens with the number) or a
    word or form of a text, hashed; texts that are numbers count as numbers.
    """
    flat = cells.where("parsed").select("feed", F.explode("cells").alias("c")).select("feed", "c.name", "c.value").where("value is not null")
    flat = join_counted(flat, names, ["feed", "name"], "left_semi")
    number = F.expr("try_cast(value as double)")
    size = F.round(F.signum(number) * F.log1p(F.abs(number) * 10) * 2)
    fraction = F.when(number != F.floor(number), ".").otherwise("")
    numeric = F.array(F.concat(F.lit("#"), size.cast("string")), F.concat(F.lit("#part"), fraction), F.concat(F.lit("#width"), F.length(F.regexp_replace("value", r"\..*", "")).cast("string")))
    words = F.transform(F.filter(F.split(F.lower("value"), r"[^\p{L}]+"), lambda w: w != ""), lambda w: F.concat(F.lit("w"), w))
    shape = F.regexp_replace(F.regexp_replace("value", r"\p{L}+", "a"), r"[0-9]+", "9")
    texts = F.concat(F.array(F.concat(F.lit("f"), shape)), words)
    items = flat.select("feed", "name", F.explode(F.transform(F.when(number.isNotNull(), numeric).otherwise(texts), lambda x: F.xxhash64(x))).alias("item"))
    return items.groupBy("feed", "name", "item").agg(F.count("*").alias("n"))


_PAIRED = "feed string, stream_id string, file_no int, old_name string, new_name string, alike double"


def _paired(pairs: pa.Table) -> pa.Table:
    """The pairs of one file, the most alike first, ties by name; each field in one pair. Their number is that of fields."""
    taken: set[tuple[int, str]] = set()
    rows = []
    for r in sorted(pairs.to_pylist(), key=lambda r: (-r["alike"], r["old_name"], r["new_name"])):
        ends = {(0, r["old_name"]), (1, r["new_name"])}
        if not ends & taken:
            taken |= ends
            rows.append(r)
    return pa.Table.from_pylist(rows, schema=pairs.schema)


def find_renames(cells: DataFrame, steps: DataFrame, statistics: DataFrame, least: float = 0.6) -> DataFrame:
    """(feed, stream_id, file_no, old_name, new_name, alike): pairs of a stopping and a starting field that carry the same content.

    Candidates are of the same type in adjoining files and never stand together
    in a file of the stream. Their contents, counted over the feed, agree if the
    cosine of their item counts is at least ``least``; each field is in one
    pair, the most alike first, ties by name. A field without values carries no
    content.
    """
    keys = ["feed", "stream_id", "file_no"]
    gone = steps.where("before and not here and old_type is not null").select(*keys, F.col("name").alias("old_name"), F.col("old_type").alias("type"))
    new = steps.where("here and not before and new_type is not null").select(*keys, F.col("name").alias("new_name"), F.col("new_type").alias("type"))
    pairs = gone.join(new, [*keys, "type"])
    names = statistics.select("feed", "stream_id", "file_id", "name").distinct()
    of_stream = ["feed", "stream_id", "old_name", "new_name"]
    together = (
        pairs.select(*of_stream).distinct().join(names.withColumnRenamed("name", "old_name"), ["feed", "stream_id", "old_name"])
        .join(names.withColumnRenamed("name", "new_name"), ["feed", "stream_id", "new_name", "file_id"]).select(*of_stream).distinct()
    )
    pairs = materialise(pairs.join(together, of_stream, "left_anti"))
    kinds = pairs.select("feed", "old_name", "new_name").distinct()
    wanted = materialise(kinds.select("feed", F.explode(F.array("old_name", "new_name")).alias("name")).distinct())
    content = materialise(_content(cells, wanted))
    norm = content.groupBy("feed", "name").agg(F.sqrt(F.sum(F.col("n").cast("double") ** 2)).alias("norm"))
    weighed = content.join(norm, ["feed", "name"]).select("feed", "name", "item", (F.col("n") / F.col("norm")).alias("w"))
    alike = (
        kinds.join(weighed.withColumnsRenamed({"name": "old_name", "w": "a"}), ["feed", "old_name"])
        .join(weighed.withColumnsRenamed({"name": "new_name", "w": "b"}), ["feed", "new_name", "item"])
        .groupBy("feed", "old_name", "new_name").agg(F.sum(F.col("a") * F.col("b")).alias("alike")).where(F.col("alike") >= least)
    )
    scored = pairs.join(alike, ["feed", "old_name", "new_name"]).selectExpr(*(f"cast({f.split()[0]} as {f.split()[1]}) {f.split()[0]}" for f in _PAIRED.split(", ")))
    return scored.groupBy(*keys).applyInArrow(_paired, _PAIRED)


def schema_changes(cells: DataFrame) -> DataFrame:
    """(feed, stream_id, file_id, change_kind, old_name, new_name) of every change against the file before.

    A stream's first file has none. A field whose values in a file are all null
    has no type there and is not retyped. Files delivered twice count once; a
    payload that is no JSON object has no fields.
    """
    cells = materialise(cells.where("file_id is not null and stream_id is not null"))
    statistics, files = materialise(field_statistics(cells)), materialise(file_steps(cells))
    steps = materialise(field_steps(statistics, files))
    renames = materialise(find_renames(cells, steps, statistics))
    keys = ["feed", "stream_id", "file_no"]
    gone = steps.where("before and not here").join(renames.select(*keys, F.col("old_name").alias("name")), [*keys, "name"], "left_anti").select(*keys, F.lit("removed").alias("change_kind"), F.col("name").alias("old_name"), F.lit("").alias("new_name"))
    new = steps.where("here and not before").join(renames.select(*keys, F.col("new_name").alias("name")), [*keys, "name"], "left_anti").select(*keys, F.lit("added").alias("change_kind"), F.lit("").alias("old_name"), F.col("name").alias("new_name"))
    typed = steps.where("here and before and old_type <> new_type").select(*keys, F.lit("retyped").alias("change_kind"), F.col("name").alias("old_name"), F.col("name").alias("new_name"))
    moved = renames.select(*keys, F.lit("renamed").alias("change_kind"), "old_name", "new_name")
    return gone.unionByName(new).unionByName(typed).unionByName(moved).join(files, keys).select("feed", "stream_id", "file_id", "change_kind", "old_name", "new_name")


def canonical_names(renames: DataFrame, statistics: DataFrame) -> dict[str, dict[str, str]]:
    """feed -> field name -> the name it goes by: of names joined by renames the one most records have, ties by name.

    Field names are schema, not data: their number doesn't grow with the rows,
    so they are resolved on the driver (more than 100,000 are refused).
    """
    counted = statistics.groupBy("feed", "name").agg(F.sum("n_records").alias("n")).limit(100_001).collect()
    if len(counted) > 100_000:
        raise ValueError("more than 100,000 different field names: the payloads' keys are data, not a schema")
    parent: dict[tuple[str, str], tuple[str, str]] = {(r["feed"], r["name"]): (r["feed"], r["name"]) for r in counted}
    weight = {(r["feed"], r["name"]): r["n"] for r in counted}

    def root(x: tuple[str, str]) -> tuple[str, str]:
        while parent[x] != x:
            x = parent[x]
        return x

    for r in renames.select("feed", "old_name", "new_name").distinct().collect():
        a, b = root((r["feed"], r["old_name"])), root((r["feed"], r["new_name"]))
        if a != b:
            keep, drop = sorted((a, b), key=lambda x: (-weight[x], x[1]))
            parent[drop] = keep
    out: dict[str, dict[str, str]] = {}
    for feed, name in parent:
        out.setdefault(feed, {})[name] = root((feed, name))[1]
    return out


def _named_cells(cells: DataFrame, names: dict[str, dict[str, str]]) -> DataFrame:
    """One row per cell with a value, under its canonical name, of each record once (the delivery that came last)."""
    pairs = [(feed, old, new) for feed, of in names.items() for old, new in of.items()]
    lookup = cells.sparkSession.createDataFrame(pairs or [("", "", "")], "feed string, name string, column_name string")
    key = ["feed", "stream_id", "file_id", "rec_no"]
    newest = cells.where("parsed").groupBy(*key).agg(F.max_by(F.struct("row_id", "as_of", "cells"), F.struct("delivered_at", "row_id")).alias("r"))
    flat = newest.select(*key, "r.row_id", "r.as_of", F.explode("r.cells").alias("c")).select(*key, "row_id", "as_of", "c.name", "c.value")
    return flat.where("value is not null").join(F.broadcast(lookup), ["feed", "name"])


_CAN = {"boolean": "try_cast(value as boolean)", "long": "try_cast(value as bigint)", "double": "try_cast(value as double)"}


def column_types(named: DataFrame) -> dict[str, dict[str, str]]:
    """feed -> column -> type: boolean, long or double where at least half of the values are, string otherwise."""
    can = named.groupBy("feed", "column_name").agg(F.count("*").alias("n"), *[F.count(F.expr(e)).alias(k) for k, e in _CAN.items()], F.count_if(F.lower("value").isin("true", "false")).alias("words"))
    out: dict[str, dict[str, str]] = {}
    for r in can.collect():
        kind = "boolean" if 2 * r["words"] >= r["n"] else "long" if r["long"] == r["double"] and 2 * r["long"] >= r["n"] else "double" if 2 * r["double"] >= r["n"] else "string"
        out.setdefault(r["feed"], {})[r["column_name"]] = kind
    return out


class DriftedFeeds:
    """The files of all streams read into one consistent table per feed."""

    def __init__(self, feed_rows: DataFrame):
        self.cells = materialise(load_cells(feed_rows).where("file_id is not null and stream_id is not null"))
        statistics, files = materialise(field_statistics(self.cells)), materialise(file_steps(self.cells))
        renames = materialise(find_renames(self.cells, materialise(field_steps(statistics, files)), statistics))
        self.names = canonical_names(renames, statistics)
        self.named = materialise(_named_cells(self.cells, self.names))
        self.types = column_types(self.named)

    def _cast(self, kind: str) -> Column:
        return F.expr(_CAN[kind]) if kind in _CAN else F.col("value")

    def table(self, feed: str) -> DataFrame:
        """One typed row per record of ``feed``; what fails its cast is null here and listed by ``failed_casts``."""
        types = self.types.get(feed, {})
        whole = self.cells.where((F.col("feed") == feed) & F.col("parsed")).groupBy("stream_id", "file_id", "rec_no").agg(F.max_by("row_id", F.struct("delivered_at", "row_id")).alias("row_id"), F.max("as_of").alias("as_of"))
        if not types:
            return whole
        clash = {c: f"{c}_value" for c in types if c in whole.columns}
        columns = [F.max(F.when(F.col("column_name") == c, self._cast(k))).alias(clash.get(c, c)) for c, k in sorted(types.items())]
        values = self.named.where(F.col("feed") == feed).groupBy("row_id").agg(*columns)
        return whole.join(values, "row_id", "left")

    def failed_casts(self) -> DataFrame:
        """(feed, file_id, column_name, wanted, n_failed, example): the values that are not of their column's type."""
        kinds = [(f, c, k) for f, of in self.types.items() for c, k in of.items()]
        lookup = self.named.sparkSession.createDataFrame(kinds or [("", "", "string")], "feed string, column_name string, wanted string")
        failed = F.expr(" or ".join(f"(wanted = '{k}' and {e} is null)" for k, e in _CAN.items()))
        return self.named.join(F.broadcast(lookup), ["feed", "column_name"]).where(failed).groupBy("feed", "file_id", "column_name", "wanted").agg(F.count("*").alias("n_failed"), F.min("value").alias("example"))
