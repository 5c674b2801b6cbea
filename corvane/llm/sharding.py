"""Operator 2: byte-balanced shards of indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.rows import fresh, materialize

#: Items that the differencing handles: every group above one part in ``PARCELS`` of all bytes is an
#: item of its own (there can be no more than ``PARCELS``), the others share ``PARCELS`` parcels.
PARCELS = 2 ** 14


def differencing(sizes: list[int], k: int) -> list[int]:
    """Shard of each item: repeatedly combine the two partial partitions of largest spread, oppositely ordered.

    A partial partition holds k sums in descending order, less their minimum, and the two partitions
    it came from with the place of each of their sums; items are read off by walking down from the last.
    """
    if not sizes:
        return []
    nodes: list[tuple] = []
    heap: list[tuple[int, int, list[int]]] = []
    for i, size in enumerate(sizes):
        nodes.append((i,))
        heap.append((-size if k > 1 else 0, i, [size] + [0] * (k - 1)))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, high = heapq.heappop(heap)
        _, b, low = heapq.heappop(heap)
        sums = [x + y for x, y in zip(high, reversed(low))]
        order = sorted(range(k), key=sums.__getitem__, reverse=True)
        least = sums[order[-1]]
        nodes.append((a, b, order))
        merged = [sums[i] - least for i in order]
        heapq.heappush(heap, (-merged[0], len(nodes) - 1, merged))
    shard = [0] * len(sizes)
    todo = [(heap[0][1], list(range(k)))]  # (partition, shard of each of its sums)
    while todo:
        at, place = todo.pop()
        if len(nodes[at]) == 1:
            shard[nodes[at][0]] = place[0]
            continue
        a, b, order = nodes[at]
        of_sum = [0] * k
        for rank, i in enumerate(order):
            of_sum[i] = place[rank]
        todo += [(a, of_sum), (b, of_sum[::-1])]
    return shard


def shard_by_bytes(docs: DataFrame, shards: int = 16, text: str = "text", parcels: int = PARCELS) -> DataFrame:
    """Add ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` to all rows (without their text).

    Rows of equal text form a group, which stays in one shard; a null text counts as an empty one.
    Sizes are summed per group with map-side partial sums, so a text that fills a third of the table
    is one row per task. Groups above one part in ``parcels`` of all bytes are items of their own, all
    others are summed into ``parcels`` parcels by hash, and the at most ``2 * parcels`` items are
    differenced. Slots count the rows of a shard from 0 in the order of the written parts.

    Returns the key and other columns but the text. Repeated rows and null ids: kept, one slot each.
    Very long texts: measured whole, never in a shuffle. Empty table: empty result. An input column of the name of a new one is replaced.
    """
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    names = ("__parcel", "__group", "__row", "__own", "__lot", "__part", "__at", "__first")
    parcel, group, row, own_shard, lot_shard, part, at, first = (fresh(docs, name) for name in names)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c not in added]
    rows = docs.select(*kept, (F.octet_length(whole) + 1).cast("bigint").alias("size"),
                       F.crc32(whole.cast("binary")).alias("text_crc32"), F.md5(whole).alias(group))
    rows = materialize(rows.withColumn(row, F.monotonically_increasing_id()), "sized")
    spark = rows.sparkSession
    groups = materialize(rows.groupBy(group).agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    hashed = F.pmod(F.xxhash64(group), F.lit(parcels))
    alone = F.col("bytes") * parcels > total
    large = groups.filter(alone).select(group, "bytes").orderBy(F.desc("bytes"), group).collect()  # < parcels rows
    small = groups.filter(~alone).groupBy(hashed.alias(parcel)).agg(F.sum("bytes").alias("bytes")) \
        .orderBy(parcel).collect()  # at most parcels rows
    where = differencing([r["bytes"] for r in large] + [r["bytes"] for r in small], shards)
    own = spark.createDataFrame([(r[group], s) for r, s in zip(large, where)], f"{group} string, {own_shard} int")
    lot = spark.createDataFrame([(r[parcel], s) for r, s in zip(small, where[len(large):])],
                                f"{parcel} bigint, {lot_shard} int")
    placed = rows.withColumn(parcel, hashed).join(F.broadcast(own), group, "left") \
        .join(F.broadcast(lot), parcel, "left").withColumn("shard", F.coalesce(own_shard, lot_shard))
    # Rows were written with the number of their part above bit 33, so (shard, part) is a bounded group.
    placed = placed.withColumn(part, F.shiftright(row, 33))
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", part).agg(F.count("*").alias(at))
    offsets = counts.select("shard", part, F.coalesce(F.sum(at).over(before), F.lit(0)).alias(first))
    inside = Window.partitionBy("shard", part).orderBy(row)
    out = placed.withColumn(at, F.row_number().over(inside) - 1).join(offsets, ["shard", part])
    return out.select(*kept, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      (F.col(first) + F.col(at)).cast("bigint").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def spread(sizes: list[int], where: list[int], k: int) -> int:
    """Largest less smallest shard, in bytes."""
    sums = np.zeros(k, np.int64)
    np.add.at(sums, where, sizes)
    return int(sums.max() - sums.min())
