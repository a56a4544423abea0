"""References to records that do not exist.

Method: the key space is cut into ranges of the hashed key, each range holds its
parents as sorted arrays, and batches of references are probed by vectorised
binary search. Ranges of the hash need no sampling pass and are even for any
key distribution; their number follows from the number of references. A key that
many references name makes its range hot: its references are dealt over as many
batches as their count needs, while the range's parents, which are few, are
copied to each batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import id_key
from ..session import join_counted, materialise, ship, shuffle_partitions

NEVER = np.iinfo(np.int64).max
ALWAYS = np.iinfo(np.int64).min
MISSING_PART = "\x02"
_OUT = "table_name string, season long, row_id long"


def composite_key(kind: str, parts: list[Column]) -> Column:
    """One text per composite key; null where a part is null. Ends in a mark, so no blank or NUL ends it."""
    joined = F.concat(F.lit(kind), *[F.concat(F.lit("\x01"), p.cast("string")) for p in parts], F.lit("|"))
    return F.when(F.length(joined) > 64, F.concat(F.lit(f"{kind}#"), F.sha2(joined, 256))).otherwise(joined)


def parent_records(df: DataFrame, kind: str, parts: list[Column]) -> DataFrame:
    """(key, start, end): when each parent record is in force. Null keys and null start never are."""
    return df.select(
        composite_key(kind, parts).alias("key"),
        F.unix_micros("loaded_at").alias("start"),
        F.coalesce(F.unix_micros("deleted_at"), F.lit(int(NEVER))).alias("end"),
    ).where("key is not null and start is not null")


def reference_rows(df: DataFrame, table_name: str, kind: str, given: Column, parts: list[Column]) -> DataFrame:
    """(table_name, season, row_id, key, at) of the rows that give the reference."""
    whole = [F.coalesce(p.cast("string"), F.lit(MISSING_PART)) for p in parts]
    return df.where(given.isNotNull()).select(
        F.lit(table_name).alias("table_name"),
        F.col("season").cast("long").alias("season"),
        F.col("row_id").cast("long").alias("row_id"),
        composite_key(kind, whole).alias("key"),
        F.coalesce(F.unix_micros("loaded_at"), F.lit(int(ALWAYS))).alias("at"),
    )


def _as_bytes(values: pa.ChunkedArray) -> np.ndarray:
    return np.array([x.encode() for x in values.to_pylist()] or [b""], dtype="S")


def probe_sorted(keys: np.ndarray, start: np.ndarray, end: np.ndarray, ref_keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a parent is in force for each reference, by binary search in arrays sorted by (key, start).

    ``end`` is replaced by its running maximum per key: among the records that
    began by the reference's time, one is still in force exactly if their
    latest end lies after it.
    """
    if not len(keys):
        return np.zeros(len(ref_keys), dtype=bool)
    order = np.lexsort((start, keys))
    keys, start, end = keys[order], start[order], end[order]
    names, first, rank = np.unique(keys, return_index=True, return_inverse=True)
    latest = end.copy()
    bounds = np.append(first, len(keys))
    for lo, hi in zip(bounds[:-1][np.diff(bounds) > 1], bounds[1:][np.diff(bounds) > 1]):
        latest[lo:hi] = np.maximum.accumulate(end[lo:hi])
    times = np.unique(start)
    width = len(times) + 1
    packed = rank.astype(np.int64) * width + np.searchsorted(times, start, "right")
    spot = np.searchsorted(names, ref_keys)
    known = (spot < len(names)) & (names[np.minimum(spot, len(names) - 1)] == ref_keys)
    wanted = spot.astype(np.int64) * width + np.searchsorted(times, at, "right")
    last = np.searchsorted(packed, wanted, "right") - 1
    safe = np.maximum(last, 0)
    return known & (last >= 0) & (rank[safe] == spot) & (latest[safe] > at)


def _misses(refs: pa.Table, parents: pa.Table) -> pa.Table:
    out = refs.select(["table_name", "season", "row_id"])
    if not refs.num_rows or not parents.num_rows:
        return out
    coded = refs["key"].combine_chunks().dictionary_encode()
    coded = coded if isinstance(coded, pa.DictionaryArray) else coded.combine_chunks()
    names = _as_bytes(pa.chunked_array([coded.dictionary]))
    keys = _as_bytes(parents["key"])
    width = max(names.dtype.itemsize, keys.dtype.itemsize)
    found = probe_sorted(
        keys.astype(f"S{width}"), parents["start"].to_numpy(), parents["end"].to_numpy(),
        names.astype(f"S{width}")[coded.indices.to_numpy(zero_copy_only=False)], refs["at"].to_numpy(),
    )
    return out.filter(pa.array(~found))


def deal(refs: DataFrame, parents: DataFrame, ranges: int | None = None, batch_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """References and parents, each with range ``g`` and batch ``s``; parents are in every batch of their range.

    There are as many ranges as the references need at ``batch_rows`` each, so
    the parents of a range are few at any size, and are copied only in the
    ranges that a hot key makes too large.
    """
    # one number comes to the driver: how many references there are
    ranges = ranges or max(shuffle_partitions(refs.sparkSession), -(-refs.count() // batch_rows))
    in_range = F.pmod(F.xxhash64("key"), F.lit(ranges)).cast("long")
    refs = refs.withColumn("g", in_range)
    hot = materialise(refs.groupBy("g").agg(F.ceil(F.count("*") / F.lit(batch_rows)).cast("int").alias("batches")).where("batches > 1"))
    known = parents.groupBy("key", "start").agg(F.max("end").alias("end")).withColumn("g", in_range)
    if hot.isEmpty():
        return refs.withColumn("s", F.lit(0)), known.withColumn("s", F.lit(0))
    # each side has a frame of its own: a cogroup could not tell the columns of one apart
    of_refs, of_parents = (hot.select("g", F.col("batches").alias(name)) for name in ("r_batches", "p_batches"))
    dealt = join_counted(refs, of_refs, ["g"], "left").withColumn("s", F.pmod(F.xxhash64("row_id"), F.coalesce("r_batches", F.lit(1))).cast("int")).drop("r_batches")
    copied = join_counted(known, of_parents, ["g"], "left").withColumn("s", F.explode(F.sequence(F.lit(0), F.coalesce("p_batches", F.lit(1)) - 1))).drop("p_batches")
    return dealt, copied


def orphan_references(refs: DataFrame, parents: DataFrame, ranges: int | None = None, batch_rows: int = 200_000) -> DataFrame:
    """Rows of ``refs`` whose key has no parent in force at their time.

    refs: (table_name, season, row_id, key, at); parents: (key, start, end).
    Returns (table_name, season, row_id), one row per orphan reference, repeated
    references included. Null keys must be left out of both sides (a row that
    gives no id is no reference); a reference without a time has no parent in
    force; empty parents make every reference an orphan; an empty ``refs``
    gives no rows.
    """
    ship(refs.sparkSession)
    dealt, known = deal(refs, parents, ranges, batch_rows)
    return dealt.groupBy("g", "s").cogroup(known.groupBy("g", "s")).applyInArrow(_misses, _OUT)


def league_references(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The references of the statistics tables to players, teams and games, with their parents."""
    pss, tss, pgs = (tables[t] for t in ("player_season_stats", "team_season_stats", "player_game_stats"))
    scope = [F.col("league"), F.col("season")]
    player, team, game = id_key("player_id"), id_key("team_id"), id_key("game_id")
    refs = (
        reference_rows(pss, "player_season_stats", "player", player, [player])
        .unionByName(reference_rows(tss, "team_season_stats", "team", team, [*scope, team]))
        .unionByName(reference_rows(pgs, "player_game_stats", "game", game, [*scope, game]))
    )
    parents = (
        parent_records(tables["players"], "player", [player])
        .unionByName(parent_records(tables["teams"], "team", [*scope, team]))
        .unionByName(parent_records(tables["games"], "game", [*scope, game]))
    )
    return refs, parents


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan references per table and season."""
    return orphans.groupBy("table_name", "season").agg(F.count("*").alias("n_orphans"))
