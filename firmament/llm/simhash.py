"""SimHash near-dedup with a Gray-order hierarchical index of fingerprints."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import bounded_batches, byte_texts, materialised, table
from firmament.llm.components import components

#: Fingerprints below one leaf of the index.
LEAF = 32
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """SimHash of the text's shingles of ``size`` words, repeats included; a bit is set if it is in over half of them."""
    words = text.translate(_FOLD).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-size]]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.array(hashes[i:i + 65_536], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints_of(size: int):
    """Task function: signed 64-bit fingerprint of each text, beside its id."""
    def run(batches):
        for batch, texts in byte_texts(batches):
            found = np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["id", "fp"])
    return run


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order, where neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code ^ (code >> np.uint64(shift))
    return code


def gray_rank_column(code: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


class GrayIndex:
    """Fingerprints in Gray order; upper nodes hold the bits that all below share, as a mask and a pattern.

    The bits in which a query differs from a node's pattern accumulate on the way down; a group is left out as soon as
    they exceed the radius.
    """

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        self.levels = []
        both, either = self.codes, self.codes
        while len(both) > LEAF:
            cuts = np.arange(0, len(both), LEAF)
            both, either = np.bitwise_and.reduceat(both, cuts), np.bitwise_or.reduceat(either, cuts)
            self.levels.append((~(both ^ either), both))

    def near(self, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, place in Gray order) at ``radius`` or fewer differing bits."""
        width = LEAF if self.levels else len(self.codes)
        tops = len(self.levels[-1][0]) if self.levels else 1
        q, node = np.repeat(np.arange(len(codes)), tops), np.tile(np.arange(tops), len(codes))
        for depth in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[depth]
            stay = np.bitwise_count((codes[q] ^ pattern[node]) & mask[node]) <= radius
            q, node = q[stay], node[stay]
            below = len(self.levels[depth - 1][0]) if depth else len(self.codes)
            q, node = _children(q, node, LEAF, below)
        if not self.levels:
            q, node = _children(q, node, width, len(self.codes))
        stay = np.bitwise_count(codes[q] ^ self.codes[node]) <= radius
        return q[stay], node[stay]


def _children(q: np.ndarray, node: np.ndarray, width: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    child = (node[:, None] * width + np.arange(width)).ravel()
    q = np.repeat(q, width)
    return q[child < below], child[child < below]


def forest_of(queries: np.ndarray, names: np.ndarray, codes: np.ndarray, others: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between names that connect all that near fingerprints connect: a spanning forest, not all pairs."""
    index = GrayIndex(codes)
    every = names if others is names else np.concatenate([names, others])
    place = index.order if others is names else index.order + len(names)
    parent = np.arange(len(every))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    links, label = [], parent.copy()
    for i in range(0, len(queries), 64):
        q, at = index.near(queries[i:i + 64], radius)
        one, two = i + q, place[at]
        apart = label[one] != label[two]
        if apart.any():
            one, two = one[apart], two[apart]
            _, new = np.unique(np.stack([label[one], label[two]]), axis=1, return_index=True)
            for k in new.tolist():
                x, y = find(one[k]), find(two[k])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((int(every[one[k]]), int(every[two[k]])))
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]
            label = parent.copy()
    return links


def links_of(radius: int):
    """Task function: rows of one or two groups of fingerprints to links within or between them."""
    def run(batches):
        for batch in batches:
            links = []
            sides = [[batch.column(i).to_pylist() for i in pair] for pair in ((0, 1), (2, 3))]
            for fps, names, more_fps, more_names in zip(*sides[0], *sides[1], strict=True):
                codes, ids = np.array(fps, np.int64).view(np.uint64), np.array(names, np.int64)
                if more_fps is None:
                    links += forest_of(codes, ids, codes, ids, radius)
                else:
                    links += forest_of(codes, ids, np.array(more_fps, np.int64).view(np.uint64), np.array(more_names, np.int64), radius)
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def near_links(prints: DataFrame, radius: int = 3, blocks: int = 4, tile: int = 1024) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints at ``radius`` or fewer differing bits, from distinct ``fp, name``.

    Fingerprints within the radius agree on ``blocks - radius`` or more of ``blocks`` groups of bits, so each is dealt to a bucket per
    such choice. A bucket is sorted by Gray rank and cut into tiles of at most ``tile``; a tile is an upper node of the
    index with mask and pattern of its shared bits, and pairs of tiles that differ in more than ``radius`` shared bits are
    pruned. What is left is searched tile by tile, with lower nodes inside the tile. So no task holds more than two tiles,
    however many fingerprints share a bucket.
    """
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)])
    dealt = prints.select("fp", "name", F.inline(keys)).withColumn("bucket", F.struct("choice", "bits")).drop("choice", "bits")
    order = Window.partitionBy("bucket").orderBy("rank")
    rank = gray_rank_column(F.col("fp")).bitwiseXOR(F.lit(-(1 << 63)))
    tiled = dealt.withColumn("rank", rank).withColumn("tile", F.floor((F.row_number().over(order) - 1) / tile))
    nodes = tiled.groupBy("bucket", "tile").agg(
        F.collect_list(F.struct("fp", "name")).alias("held"), F.bit_and("fp").alias("both"), F.bit_or("fp").alias("either"))
    nodes = materialised(nodes.where((F.size("held") > 1) | (F.col("tile") > 0)).select(
        "bucket", "tile", F.col("held.fp").alias("fps"), F.col("held.name").alias("names"),
        F.col("both").alias("pattern"), F.bitwise_not(F.col("both").bitwiseXOR(F.col("either"))).alias("mask")), "gray-nodes")
    inside = nodes.select("fps", "names", F.lit(None).cast("array<bigint>").alias("more_fps"), F.lit(None).cast("array<bigint>").alias("more_names"))
    large = nodes.join(nodes.where("tile > 0").select("bucket").distinct(), "bucket")
    left = large.select("bucket", *[F.col(c).alias(f"left_{c}") for c in ("tile", "fps", "names", "pattern", "mask")])
    shared = F.col("left_pattern").bitwiseXOR(F.col("pattern")).bitwiseAND(F.col("left_mask")).bitwiseAND(F.col("mask"))
    across = left.join(large, "bucket").where((F.col("left_tile") < F.col("tile")) & (F.bit_count(shared) <= radius))
    across = across.select(F.col("left_fps").alias("fps"), F.col("left_names").alias("names"), F.col("fps").alias("more_fps"), F.col("names").alias("more_names"))
    return inside.unionByName(across).mapInArrow(links_of(radius), "a long, b long").distinct()


def simhash_groups(docs: DataFrame, radius: int = 3, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each document and the group of near copies it belongs to: ``id_col, fingerprint, component_id``.

    Texts are lower-cased in A-Z and cut into words at ASCII blanks; their shingles of ``size`` words (the whole sequence if shorter)
    vote bit by bit. Null texts and texts without words have fingerprint zero, linked like any other. Documents whose
    fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the smallest id reachable. Ids are whole
    numbers; a document without id belongs to its fingerprint's group but links nothing, and a group of such has no id.
    Rows that repeat an id each get a row. An empty table gives no rows.

    Equal fingerprints are one node, named by their smallest id, so copies are never paired.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = materialised(texts.mapInArrow(fingerprints_of(size), "id long, fp long"), "fingerprints")
    distinct = materialised(prints.groupBy("fp").agg(F.min("id").alias("name")), "distinct-fingerprints")
    links = near_links(distinct.where(F.col("name").isNotNull()), radius)
    names = components(links)
    grouped = distinct.join(names, distinct["name"] == names["node"], "left").select(
        "fp", F.coalesce("component", "name").alias("component_id"))
    return prints.join(grouped, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_simhash(spark, folder: str) -> DataFrame:
    return simhash_groups(table(spark, folder, "documents"))
