"""Sharding: consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmament.llm.common import materialised, table


def ring(spark: SparkSession, shards: int, nodes: int, seed: int) -> list[tuple[int, int]]:
    """The ring's points (place, shard) in clockwise order.

    Each shard owns ``nodes`` points at hashed places. The arc that ends at a point belongs to the point's shard, and
    the arc behind the last point wraps to the first. Two points never share a place (ties go to the lower shard).
    """
    points = spark.range(shards * nodes).select((F.col("id") / nodes).cast("int").alias("shard"), (F.col("id") % nodes).alias("node"))
    places = points.groupBy(F.xxhash64(F.lit(seed), "shard", "node").alias("place")).agg(F.min("shard").alias("shard"))
    return sorted((r.place, r.shard) for r in places.collect())


def settle(arcs: list[tuple[int, int]], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Where the keys of each arc end up: rows ``(arc, first rank, end rank, shard, first slot)``.

    ``arcs`` holds (shard, number of keys) clockwise. In every round each arc offers what it holds to its own shard,
    which takes keys while it has room; the rest continue to the next arc. Work and result depend on the number of arcs
    only, never on the number of keys.
    """
    used = [0] * len(capacity)
    waiting = [[(i, 0, n)] if n else [] for i, (_, n) in enumerate(arcs)]
    placed = []
    while any(waiting):
        passed_on: list[list[tuple[int, int, int]]] = [[] for _ in arcs]
        for i, groups in enumerate(waiting):
            shard = arcs[i][0]
            for arc, first, end in groups:
                taken = min(end - first, capacity[shard] - used[shard])
                if taken:
                    placed.append((arc, first, first + taken, shard, used[shard]))
                    used[shard] += taken
                if first + taken < end:
                    passed_on[(i + 1) % len(arcs)].append((arc, first + taken, end))
        waiting = passed_on
    return placed


def ring_shards(docs: DataFrame, shards: int = 24, nodes: int = 64, seed: int = 7, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Every document's shard and its slot there: ``id_col, size, text_crc32, shard, slot``.

    A key is placed on the ring by the hash of its id and text checksum, and belongs to the first point clockwise. A
    shard holds at most its share of the rows (shares differ by one at most); keys above it continue clockwise
    to the next shard with room, so that row counts end at most one apart. Slots count from 0 in each shard.

    ``size`` is the text's UTF-8 length plus 8; a null text has no bytes. Null ids are hashed by their text alone, and
    rows that repeat are separate keys at one place. An empty table gives no rows; a table with fewer rows than shards
    leaves shards empty. The keys stay distributed: only counts per arc (``shards * nodes`` rows at most) reach the driver.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keys = materialised(
        docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                    F.crc32(text).alias("text_crc32")), "shard-keys")
    points = ring(spark, shards, nodes, seed)
    keys = keys.select("*", F.xxhash64(F.lit(seed), "id", "text_crc32").alias("place"))
    keys = keys.withColumn("arc", _arc_of(F.col("place"), [place for place, _ in points]))

    held = {r.arc: r["count"] for r in keys.groupBy("arc").count().collect()}
    rows = sum(held.values())
    capacity = [rows // shards + (s < rows % shards) for s in range(shards)]
    placed = settle([(shard, held.get(arc, 0)) for arc, (_, shard) in enumerate(points)], capacity)
    by_arc: dict[int, list[tuple[int, int, int, int]]] = {}
    for arc, first, end, shard, slot in placed:
        by_arc.setdefault(arc, []).append((first, end, shard, slot))
    placement = spark.createDataFrame(
        [(arc, parts) for arc, parts in by_arc.items()],
        "arc int, parts array<struct<first:long,end:long,shard:int,slot:long>>")

    order = Window.partitionBy("arc").orderBy("place", "id", "text_crc32", "size")
    ranked = keys.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    part = F.filter("parts", lambda p: (p["first"] <= F.col("rank")) & (F.col("rank") < p["end"]))[0]
    return ranked.join(F.broadcast(placement), "arc").select(
        F.col("id").alias(id_col), "size", "text_crc32", part["shard"].alias("shard"),
        (part["slot"] + F.col("rank") - part["first"]).alias("slot"))


def _arc_of(place: Column, ends: list[int]) -> Column:
    """Number of the arc that holds ``place``: arcs before it all end at smaller places.

    ``width_bucket``-like lookup in a literal array that is cut by the place's top byte, so a key is compared with a few
    ends only.
    """
    top = F.shiftright(place, 56)
    starts, inside = {}, {}
    for b in range(-128, 128):
        inside[b] = [e for e in ends if e >> 56 == b]
        starts[b] = sum(e >> 56 < b for e in ends)
    bases = F.array(*[F.lit(starts[b]) for b in range(-128, 128)])
    spans = F.array(*[F.array(*[F.lit(e).cast("long") for e in inside[b]]).cast("array<bigint>") for b in range(-128, 128)])
    at = (top + 129).cast("int")
    arc = F.element_at(bases, at) + F.size(F.filter(F.element_at(spans, at), lambda e: e < place))
    return (arc % len(ends)).cast("int")


def op3_ring_shards(spark, folder: str) -> DataFrame:
    return ring_shards(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
