"""Problem 9: items into containers of fixed capacity, best fit decreasing with a segment tree over free room."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, ITEMS_PER_SHARD, REPEATS = 2048, 50_000, 4096


class RoomTree:
    """Open containers by free room; finds the tightest that still takes a size, in logarithmic time."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.some = [0] * (2 * self.leaves)  # containers below each node
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, container: int) -> None:
        self.bins[room].append(container)
        node = self.leaves + room
        while node:
            self.some[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, container) of the tightest container with room for ``size``, taken out; None if none has."""
        node = self.leaves + size
        if not self.some[node]:
            while node > 1 and (node & 1 or not self.some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        room = node - self.leaves
        container = self.bins[room].pop()
        while node:
            self.some[node] -= 1
            node >>= 1
        return room, container


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Container number of each item and how many containers there are; sizes are at most ``capacity``."""
    tree, out, made = RoomTree(capacity), np.zeros(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = tree.take(size)
        if found is None:
            found, made = (capacity, made), made + 1
        out[i] = found[1]
        tree.add(found[0] - size, found[1])
    return out, made


def pack(items: DataFrame, shards: int, capacity: int = CAPACITY, item: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """item, piece_no, first_unit, n_units, container_id of every piece.

    An item larger than a container is cut into full pieces and a rest; others stay whole. Items of size 0 (a null
    size counts as 0) take no room and stand in the tightest container. Repeated items are packed each for itself.
    Items are dealt over shards by item, size and number among their repeats, so an item that is a third of all rows is
    shared out and containers come out alike on every run, and each shard of some 50,000 items is packed by best fit
    decreasing: a shard wastes at most its last container, so the loss against one global packing is below a
    container per shard. An empty table gives no rows.
    """
    kind = dict(items.dtypes)[item]
    counted = items.groupBy(F.col(item).alias("item"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size")).agg(F.count("*").alias("n"))
    # Repeats are told apart by a number, dealt in two steps, so none makes a long list.
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / REPEATS))))
    ranked = blocks.select("item", "size", F.explode(F.sequence(F.col("block") * REPEATS, F.least((F.col("block") + 1) * REPEATS, F.col("n")) - 1)).alias("no"))
    dealt = ranked.withColumn("shard", F.pmod(F.xxhash64("item", "size", "no"), F.lit(shards)))

    def run(key, table):
        table = table.sort_by([("size", "descending"), ("item", "ascending"), ("no", "ascending")])
        sizes = table.column("size").to_numpy()
        full, rest = sizes // capacity, sizes % capacity
        has_rest = (rest > 0) | (full == 0)
        owner = np.concatenate([np.repeat(np.arange(len(sizes)), full), np.flatnonzero(has_rest)])
        first_full = np.concatenate([[0], np.cumsum(full)])[:-1]
        number = np.arange(full.sum()) - np.repeat(first_full, full)
        fitted, made = best_fit_decreasing(rest[has_rest], capacity)
        piece = np.concatenate([number, full[has_rest]])
        units = np.concatenate([np.full(full.sum(), capacity), rest[has_rest]])
        container = np.concatenate([made + np.arange(full.sum()), fitted]) + (key[0].as_py() << 32)
        return pa.table({"item": table.column("item").take(pa.array(owner)), "piece_no": pa.array(piece.astype(np.int32)), "first_unit": pa.array((piece * capacity).astype(np.int64)), "n_units": pa.array(units.astype(np.int32)), "container_id": pa.array(container.astype(np.int64))})

    return dealt.groupBy("shard").applyInArrow(run, f"item {kind}, piece_no int, first_unit bigint, n_units int, container_id bigint").withColumnRenamed("item", item)


def shards_for(rows: int, items_per_shard: int = ITEMS_PER_SHARD) -> int:
    return max(1, -(-rows // items_per_shard))
