"""Sharding by best-fit-decreasing bin packing.

Documents of equal text are indivisible. Groups are packed in two levels, so that no task and no driver
holds them all: each task packs its small groups, largest first, into pallets of fixed capacity; the
pallets and the few large groups, whose number is bounded by the pallet's size, are then packed into
shards. At both levels an item enters the bin of tightest remaining capacity, found in a balanced tree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import parallelism, stage_table


class RoomTree:
    """An AVL tree of (room, bin): insert, and take out the least entry with enough room."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # [key, left, right, height]

    @staticmethod
    def _fix(n: list) -> list:
        height = lambda x: x[3] if x else 0

        def turn(n: list, up: int, down: int) -> list:
            top = n[up]
            n[up], top[down] = top[down], n
            for x in (n, top):
                x[3] = 1 + max(height(x[1]), height(x[2]))
            return top

        n[3] = 1 + max(height(n[1]), height(n[2]))
        lean = height(n[1]) - height(n[2])
        if abs(lean) < 2:
            return n
        up, down = (1, 2) if lean > 0 else (2, 1)
        if height(n[up][down]) > height(n[up][up]):
            n[up] = turn(n[up], down, up)
        return turn(n, up, down)

    def add(self, key: tuple[int, int]) -> None:
        def put(n):
            if n is None:
                return [key, None, None, 1]
            side = 1 if key < n[0] else 2
            n[side] = put(n[side])
            return self._fix(n)

        self.root = put(self.root)

    def take(self, room: int) -> tuple[int, int] | None:
        """Remove and return the tightest entry of at least ``room``."""
        best, n = None, self.root
        while n:
            if n[0][0] >= room:
                best, n = n[0], n[1]
            else:
                n = n[2]
        if best is not None:
            self.root = self._drop(self.root, best)
        return best

    def _drop(self, n, key):
        if key < n[0]:
            n[1] = self._drop(n[1], key)
        elif key > n[0]:
            n[2] = self._drop(n[2], key)
        elif n[1] is None or n[2] is None:
            return n[1] or n[2]
        else:
            least = n[2]
            while least[1]:
                least = least[1]
            n[0] = least[0]
            n[2] = self._drop(n[2], least[0])
        return self._fix(n)


def best_fit(sizes: Iterable[int], capacity: int) -> list[int]:
    """A bin for each size, given in descending order; an item above the capacity gets a bin of its own."""
    rooms, out, bins = RoomTree(), [], 0
    for size in sizes:
        found = rooms.take(size)
        if found is None:
            found, bins = (max(capacity, size), bins), bins + 1
        out.append(found[1])
        if found[0] > size:
            rooms.add((found[0] - size, found[1]))
    return out


def fit_into(sizes: list[int], bins: int) -> list[int]:
    """Bins for descending sizes, of the least capacity for which best fit needs no more than ``bins``."""
    low = max(sizes[:1] + [-(-sum(sizes) // bins)])
    high = max(low, 2 * low)
    while max(best_fit(sizes, high), default=0) >= bins:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        if max(best_fit(sizes, middle), default=0) < bins:
            high = middle
        else:
            low = middle + 1
    return best_fit(sizes, high)


def pack_documents(
    docs: DataFrame,
    *,
    shards: int | None = 8,
    capacity: int | None = None,
    pallets: int = 4096,
    group_rows_per_task: int = 500_000,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    Size is the text's UTF-8 bytes (null: none) plus 1. With ``shards`` the sizes of that many shards are
    made near equal (law ``bytes``); with ``capacity`` as few shards of that capacity as best fit needs are
    opened, a larger group getting its own. Equal texts share a shard, and null is a text of its own.
    ``slot`` numbers a shard's rows without gaps from 0. ``grown_shard`` is null under this law.

    Rows that repeat, null ids and further columns need nothing special; an empty table gives no rows.
    ``pallets`` bounds what the driver packs: at most that many full pallets, one partly filled pallet a
    task, and twice that many large groups.
    """
    text = F.col("text").cast("binary")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        F.xxhash64(F.col("text"), F.col("text").isNull()).alias("group"),
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("weight"))
    groups = stage_table(groups, "groups")
    n, total, most = groups.agg(F.count("*"), F.sum("weight"), F.max("weight")).first()
    limit = max(1, (total or 0) // pallets)
    if capacity:
        limit = min(limit, max(1, capacity // 8))
    tasks = max(parallelism(docs.sparkSession), -(-n // group_rows_per_task))

    def palletise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple[int, int]] = []
        part = tasks
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("weight", "group", "part")]
            items += [(-w, g) for w, g, _ in zip(*columns)]
            part = min([part, *columns[2]])
        items.sort()
        bins = best_fit([-w for w, _ in items], limit)
        names = pa.array([f"{part}-{b}" for b in bins], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([g for _, g in items], pa.int64()), names, pa.array([-w for w, _ in items], pa.int64())], ["group", "pallet", "weight"])

    small = groups.where(F.col("weight") * 2 < limit).withColumn("part", F.pmod(F.xxhash64("group"), F.lit(tasks)))
    small = small.repartition(tasks, "part").select("weight", "group", "part")
    # every task's pallets carry the number of its least part, so names are unique
    loaded = small.mapInArrow(palletise, "group bigint, pallet string, weight bigint")
    large = groups.where(F.col("weight") * 2 >= limit).select("group", F.concat(F.lit("g"), F.col("group")).alias("pallet"), "weight")
    loaded = stage_table(loaded.unionByName(large), "pallets")
    items = loaded.groupBy("pallet").agg(F.sum("weight").alias("w")).orderBy(F.desc("w"), "pallet").collect()
    sizes = [r.w for r in items]
    bins = best_fit(sizes, capacity) if capacity else fit_into(sizes, shards)
    spark = docs.sparkSession
    placed = spark.createDataFrame([(r.pallet, b) for r, b in zip(items, bins)], "pallet string, shard int")
    where = loaded.join(F.broadcast(placed), "pallet").select("group", "shard")
    out = rows.join(where, "group")
    # slots: rows are numbered inside many parts of a shard, then shifted by what the parts before hold
    parts = max(8, tasks)
    out = stage_table(out.withColumn("part", F.pmod(F.xxhash64("doc_id", "group"), F.lit(parts)).cast("int")), "sharded")
    counts = out.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "group", "size")
    numbered = out.withColumn("slot", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(counts) if (max(bins, default=0) + 1) * parts <= 200_000 else counts, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("slot")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
