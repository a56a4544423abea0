"""Filling fixed-capacity containers with items.

Method: bounded-space online packing. Every partition keeps a fixed number of
open windows per container kind; an item goes to the window it fits best; when
none has room the fullest window is closed and emitted and a new one opened.
What stays open is merged: the items of the windows left open (a window of many
items as one) are packed anew, largest first, in rounds of ever fewer partitions,
until one is left; each round passes on the bins with most room. Items above the capacity are split into full
pieces and a rest; no other item is split. Partitions and the order in them
follow from the ids alone, so a task that is run again packs alike.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, shuffle_partitions

ITEM = "container string, capacity long, doc_id long, piece_no int, n_tokens long, window string, slot int"
_ITEM = pa.schema([("container", pa.string()), ("capacity", pa.int64()), ("doc_id", pa.int64()), ("piece_no", pa.int32()), ("n_tokens", pa.int64()), ("window", pa.string()), ("slot", pa.int32())])


class Windows:
    """The open windows of one container kind in one partition, sorted by room."""

    def __init__(self, capacity: int, most: int, mark: str):
        self.capacity, self.most, self.mark = capacity, most, mark
        self.open: list[tuple[int, int]] = []
        self.held: dict[int, int] = {}
        self.opened = 0

    def name(self, number: int) -> str:
        return f"{self.mark}.{number}"

    def new(self) -> int:
        self.opened += 1
        return self.opened

    def place(self, size: int) -> tuple[int, int]:
        """The window the item goes to, and its place in it: of those with room the one with the least, else a new one in place of the fullest."""
        at = bisect_left(self.open, (size, 0))
        if at < len(self.open):
            room, number = self.open.pop(at)
        else:
            if len(self.open) >= self.most:
                self.held.pop(self.open.pop(0)[1])
            room, number = self.capacity, self.new()
        insort(self.open, (room - size, number))
        self.held[number] = self.held.get(number, 0) + 1
        return number, self.held[number]


def pack_items(sizes: DataFrame, containers: list[tuple[str, int]], partitions: int, most_open: int) -> DataFrame:
    """Every piece of every item with its window; rows without doc_id and piece_no tell the fill of the windows left open, and as slot the number of their items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[Windows] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, tokens, parts = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "part"))
            if kinds is None:
                kinds = [Windows(capacity, most_open, f"{name}-{parts[0]}") for name, capacity in containers]
            for (name, capacity), windows in zip(containers, kinds):
                doc, piece, size, window, slot = [], [], [], [], []
                for i, n in zip(ids, tokens):
                    n = max(n or 0, 0)
                    k = 0
                    while n > capacity:
                        doc.append(i), piece.append(k), size.append(capacity), window.append(windows.name(windows.new())), slot.append(0)
                        n -= capacity
                        k += 1
                    number, place = windows.place(n)
                    doc.append(i), piece.append(k), size.append(n), window.append(windows.name(number)), slot.append(place)
                rows = len(doc)
                yield pa.RecordBatch.from_arrays([pa.array([name] * rows), pa.array([capacity] * rows, pa.int64()), pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(size, pa.int64()), pa.array(window), pa.array(slot, pa.int32())], schema=_ITEM)
        for (name, capacity), windows in zip(containers, kinds or []):
            left = [{"container": name, "capacity": capacity, "n_tokens": capacity - room, "window": windows.name(number), "slot": windows.held[number]} for room, number in windows.open if room]
            yield pa.RecordBatch.from_pylist(left, schema=_ITEM)

    part = F.pmod(F.xxhash64("doc_id"), F.lit(partitions)).cast("int")
    # the part is the partition: a hash of it would put several into one task and none into others
    placed = sizes.select("doc_id", "n_tokens", part.alias("part")).repartitionById(partitions, "part").sortWithinPartitions("part", "doc_id", "n_tokens")
    return placed.mapInArrow(run, ITEM)


def _merge_round(units: DataFrame, partitions: int, most_open: int, number: int) -> DataFrame:
    """(container, capacity, unit, n_tokens, bin_id, kept): units packed largest first, each where it fits best, per group of partitions.

    ``kept`` marks the bins with most room of a group, whose units the next round takes up.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["n_tokens"].to_pylist(), table["unit"].to_pylist()), reverse=True)
        capacity = table["capacity"][0].as_py()
        rooms: list[tuple[int, int]] = []
        bins: list[int] = []
        opened = 0
        for size, _ in rows:
            at = bisect_left(rooms, (size, -1))
            if at < len(rooms):
                room, n = rooms.pop(at)
            else:
                room, n, opened = capacity, opened, opened + 1
            bins.append(n)
            insort(rooms, (room - size, n))
        kept = {n for room, n in rooms[-most_open:] if room}
        name = f"{key[0].as_py()}~{number}.{key[1].as_py()}"
        return pa.table({
            "container": [key[0].as_py()] * len(rows), "capacity": pa.array([capacity] * len(rows), pa.int64()), "unit": [u for _, u in rows], "n_tokens": pa.array([n for n, _ in rows], pa.int64()),
            "bin_id": [f"{name}.{n}" for n in bins], "kept": pa.array([n in kept for n in bins], pa.bool_()),
        })

    grouped = units.withColumn("g", F.pmod(F.xxhash64("unit", F.lit(number)), F.lit(partitions)).cast("int"))
    return grouped.groupBy("container", "g").applyInArrow(run, "container string, capacity long, unit string, n_tokens long, bin_id string, kept boolean")


def pack(sizes: DataFrame, capacities: DataFrame, most_open: int = 256, partitions: int | None = None, alone_below: int = 32) -> DataFrame:
    """(container, capacity, doc_id, piece_no, n_tokens, bin_id) of every piece of every document for every container kind.

    sizes: (doc_id, n_tokens), null or negative sizes count as 0; an item of
    size 0 takes a place like any other. capacities: (container,
    capacity_tokens), a few rows; kinds without a positive capacity hold
    nothing and are left out. Rows that repeat a doc_id are items of their own.
    Windows of more than ``alone_below`` items are merged whole.
    """
    kinds = capacities.where("container is not null and capacity_tokens > 0").groupBy("container").agg(F.max("capacity_tokens").alias("c")).orderBy("container").limit(1_001).collect()
    if len(kinds) > 1_000:
        raise ValueError("more than 1,000 kinds of containers")
    containers = [(r["container"], int(r["c"])) for r in kinds]
    parts = partitions or 2 * shuffle_partitions(sizes.sparkSession)
    placed = materialise(pack_items(sizes, containers, parts, most_open))
    # a doc_id may be null, a piece's number never is
    left = placed.where("piece_no is null").select("window", F.col("n_tokens").alias("fill"), F.col("slot").alias("held"), F.col("container").alias("of"), F.col("capacity").alias("room"))
    alone = F.col("held") <= alone_below
    items = placed.where("piece_no is not null").join(left.select("window", "held"), "window", "left").withColumn("unit", F.when(alone, F.concat_ws("#", "window", "slot")).when(F.col("held").isNotNull(), F.col("window")))
    units = (
        items.where(alone).select("container", "capacity", "unit", "n_tokens")
        .unionByName(left.where(~alone).select(F.col("of").alias("container"), F.col("room").alias("capacity"), F.col("window").alias("unit"), F.col("fill").alias("n_tokens")))
    )
    moves, number = None, 0
    while True:
        parts, number = -(-parts // 16), number + 1
        merged = materialise(_merge_round(units, parts, most_open, number))
        now = merged.select("unit", "bin_id")
        # a unit that is taken up again stays where the last round puts it
        moves = now if moves is None else materialise(moves.join(now.withColumnRenamed("bin_id", "later"), "unit", "left").select("unit", F.coalesce("later", "bin_id").alias("bin_id")))
        units = merged.where("kept").select("container", "capacity", "unit", "n_tokens")
        if parts == 1:
            break
    return items.join(moves, "unit", "left").select("container", "capacity", "doc_id", "piece_no", "n_tokens", F.coalesce("bin_id", "window").alias("bin_id"))


def packing_waste(packed: DataFrame) -> DataFrame:
    """Per container kind: bins, tokens, the least number of bins there could be, and the share of room left unused."""
    return packed.groupBy("container", "capacity").agg(
        F.count_distinct("bin_id").alias("n_bins"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_pieces"), F.ceil(F.sum("n_tokens") / F.first("capacity")).alias("least_bins")
    ).withColumn("waste", F.round(1 - F.col("n_tokens") / (F.col("n_bins") * F.col("capacity")), 6))
