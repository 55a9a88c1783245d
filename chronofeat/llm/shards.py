"""Sharding over fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofeat.llm.common import Scratch
from chronofeat.session import new_shared_path

#: Virtual slots; a record's slot never changes. All per-slot data is bounded by this number.
SLOTS = 4096


def virtual_slot(*key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


class SlotMap:
    """Versions of the slot-to-shard map, one folder each under `path`.

    `edit` stores a new version in which as few slots as needed have moved; records are never
    rehashed, so a version change moves whole slots and nothing else.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or new_shared_path(spark, "slot-map")

    def save(self, version: int, shards: list[int], sizes: list[int]) -> None:
        rows = self.spark.range(len(shards)).select(
            F.col("id").cast("int").alias("slot"),
            lookup(shards, F.col("id")).cast("int").alias("shard"),
            lookup(sizes, F.col("id")).alias("bytes"),
        )
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def load(self, version: int) -> list[int]:
        rows = self.spark.read.parquet(f"{self.path}/version={version}").collect()
        return [r["shard"] for r in sorted(rows, key=lambda r: r["slot"])]

    def edit(self, version: int, sizes: list[int], shards: int) -> list[int]:
        """Rebalance `version` to `shards` shards by bytes and store the result as the next one."""
        new = rebalance(self.load(version), sizes, shards)
        self.save(version + 1, new, sizes)
        return new


def lookup(values: list[int], index: Column) -> Column:
    """`values[index]` from a list of bounded length that travels as one constant of the plan."""
    table = F.from_json(F.lit(json.dumps(values)), "array<bigint>")
    return F.element_at(table, index.cast("int") + 1)


#: Shards count as equal when the fullest and the emptiest differ by this part of the mean.
TOLERANCE = 0.001


def rebalance(current: list[int], sizes: list[int], shards: int) -> list[int]:
    """Move slots, and swap pairs where no move helps, until shards are equal or nothing helps.

    Slots of shards that no longer exist move first. The list has one entry per slot, so this is
    bookkeeping over a fixed number of totals, whatever the data's size.
    """
    new, load = list(current), [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(current):
        if 0 <= shard < shards:
            load[shard] += sizes[slot]
            members[shard].add(slot)
        else:
            homeless.append(slot)

    def move(slot: int, to: int) -> None:
        if 0 <= new[slot] < shards:
            load[new[slot]] -= sizes[slot]
            members[new[slot]].discard(slot)
        new[slot] = to
        load[to] += sizes[slot]
        members[to].add(slot)

    for slot in sorted(homeless, key=lambda s: (-sizes[s], s)):
        move(slot, min(range(shards), key=lambda s: (load[s], s)))
    close = TOLERANCE * sum(sizes) / shards
    while True:
        full = max(range(shards), key=lambda s: (load[s], -s))
        empty = min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        if gap <= close:
            return new
        moves = [s for s in members[full] if 0 < sizes[s] < gap]
        if moves:
            move(min(moves, key=lambda s: (abs(gap - 2 * sizes[s]), s)), empty)
            continue
        swap = _best_swap(members[full], members[empty], sizes, gap)
        if swap is None:
            return new
        move(swap[0], empty)
        move(swap[1], full)


def _best_swap(full: set[int], empty: set[int], sizes: list[int], gap: int) -> tuple | None:
    pairs = (
        (abs(gap - 2 * (sizes[a] - sizes[b])), a, b)
        for a in full
        for b in empty
        if 0 < sizes[a] - sizes[b] < gap
    )
    best = min(pairs, default=None)
    return best and best[1:]


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 16,
    slots: int = SLOTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    slot_map: SlotMap | None = None,
) -> DataFrame:
    """Deal `docs` to `shards` shards of nearly equal bytes: id, size, text_crc32, vslot, shard, slot.

    A record's virtual slot is the hash of its id, size and checksum. The map's first version deals
    slots round-robin; its second is edited by the bytes each slot holds. `slot` is the place in the
    shard, gapless from 0: rows of lower virtual slots come first, so only rows of one virtual slot
    are ever sorted together. A null text has size 1, as the empty one has; null ids hash as null.
    Repeated rows share a virtual slot and get places of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = virtual_slot(F.col("doc_id"), F.col("size"), F.col("text_crc32"), slots=slots)
    rows = Scratch(spark, "shards").keep(rows.withColumn("vslot", key), "rows")

    sizes, counts = [0] * slots, [0] * slots
    totals = rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    for r in totals.collect():  # at most `slots` rows
        sizes[r["vslot"]], counts[r["vslot"]] = r["b"], r["n"]
    slot_map = slot_map or SlotMap(spark)
    slot_map.save(0, [s % shards for s in range(slots)], sizes)
    owner = slot_map.edit(0, sizes, shards)
    before, filled = [0] * slots, [0] * shards
    for s in range(slots):
        before[s] = filled[owner[s]]
        filled[owner[s]] += counts[s]

    within = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")
    place = lookup(before, F.col("vslot")) + F.row_number().over(within) - 1
    return rows.select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        "vslot",
        lookup(owner, F.col("vslot")).cast("int").alias("shard"),
        place.cast("long").alias("slot"),
    )
