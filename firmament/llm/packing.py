"""Packing: full windows are cut off, what remains of each document is packed by best-fit decreasing."""

from __future__ import annotations

import base64
import json
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import bounded_batches, materialised, table

_ENCODERS: dict[str, tiktoken.Encoding] = {}
_ADDED: dict[str, dict[str, int]] = {}


def encoder(ranks_file: str) -> tiktoken.Encoding:
    """Byte-level BPE of a ranks file, kept per worker, for text between added tokens."""
    if ranks_file not in _ENCODERS:
        with open(public_tokenizers.path(ranks_file), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODERS[ranks_file] = tiktoken.Encoding(ranks_file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[ranks_file]


def added_tokens(ranks_file: str) -> dict[str, int]:
    """Ids of the tokens that the tokenizer's JSON adds to the vocabulary, kept per worker; none for ranks without a JSON."""
    if ranks_file not in _ADDED:
        path = public_tokenizers.path(ranks_file.removesuffix(".tiktoken") + ".json")
        added = []
        if os.path.exists(path):
            with open(path, encoding="utf-8") as file:
                added = json.load(file)["added_tokens"]
        if any(t[option] for t in added for option in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens that match otherwise than by their plain text")
        _ADDED[ranks_file] = {t["content"]: t["id"] for t in added}
    return _ADDED[ranks_file]


def token_ids(ranks_file: str):
    """Function from a text to its ids: added tokens are cut out first, what lies between them is encoded piece by piece."""
    encode, added = encoder(ranks_file).encode_ordinary, added_tokens(ranks_file)
    if not added:
        return encode
    find = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")

    def ids(text: str) -> list[int]:
        parts = find.split(text)
        if len(parts) == 1:
            return encode(text)
        return [i for k, part in enumerate(parts) for i in ([added[part]] if k % 2 else encode(part))]
    return ids


def pieces_of(window: int, ranks_file: str, end_id: int):
    """Task function: a row per piece of each text, cut into full windows from its start."""
    def run(batches):
        encode = token_ids(ranks_file)
        for batch in batches:
            rows, starts, lengths, crcs, totals = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(text), end_id] if text else [end_id], dtype="<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    rows.append(i)
                    starts.append(start)
                    lengths.append(len(piece))
                    crcs.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)]],
                names=["id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


class OpenWindows:
    """Segment tree over remaining capacity: which capacities have open windows, and the tightest that still fits."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.any = [False] * (2 * self.size)
        self.groups: dict[int, list[tuple[int, int]]] = {}

    def add(self, capacity: int, first: int, end: int) -> None:
        self.groups.setdefault(capacity, []).append((first, end))
        self._mark(capacity, True)

    def take(self, capacity: int) -> tuple[int, int]:
        group = self.groups[capacity].pop()
        if not self.groups[capacity]:
            self._mark(capacity, False)
        return group

    def tightest(self, length: int) -> int | None:
        """Smallest capacity of at least ``length`` with an open window."""
        node = length + self.size
        if self.any[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None

    def _mark(self, capacity: int, value: bool) -> None:
        node = capacity + self.size
        self.any[node] = value
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]


def best_fit(counts: dict[int, int], window: int, first_id: int = 0) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram: rows ``(length, first rank, end rank, first sequence, offset)``.

    The pieces of one length are alike, so windows with the same contents are handled as one range of sequence numbers:
    as many pieces as the tightest group of windows has are placed at once, exactly as one after the other would be.
    The work depends on the number of lengths (below ``window``), not on the number of pieces.
    """
    windows, placed, fresh = OpenWindows(window), [], first_id
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = windows.tightest(length)
            if capacity is None:
                capacity, first = window, fresh
                end = fresh = fresh + -(-left // (window // length))
            else:
                first, end = windows.take(capacity)
            fits = capacity // length
            filled = min(end - first, left // fits)
            # Windows filled up with this length, then at most one with what is left of it.
            for width, times in ((filled, fits), (1, left % fits if first + filled < end and left // fits == filled else 0)):
                for i in range(times if width else 0):
                    placed.append((length, rank, rank + width, first, window - capacity + i * length))
                    rank, left = rank + width, left - width
                if width and times:
                    if capacity > times * length:
                        windows.add(capacity - times * length, first, first + width)
                    first += width
            if first < end:
                windows.add(capacity, first, end)
    return placed


def pack(docs: DataFrame, window: int = 1024, ranks_file: str = "byte_bpe_50k.tiktoken", end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", rows_per_salt: int = 100_000, least_salts: int = 64) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    Returns one row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A document is its
    token ids (added tokens of the tokenizer's JSON are one token wherever their string stands) and ``end_id``; a null or empty text is ``end_id`` alone. Overlong documents are first cut into full
    windows, each a sequence of its own; the rest of each document is placed by best-fit decreasing. Null ids and rows
    that repeat an id are packed like any other; an empty table gives no rows. Sequence ids start at 0 without gaps.

    Only the number of pieces per length (``window`` rows at most) reaches the driver, which returns a placement table
    of ranks. Pieces of a length are ranked in ``least_salts`` or more salted groups, so a common length isn't one task.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    pieces = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = pieces.schema["id"].dataType.simpleString()
    pieces = materialised(pieces.mapInArrow(
        pieces_of(window, ranks_file, end_id), f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"), "pieces")

    rows = pieces.count()
    salts = max(least_salts, rows // rows_per_salt)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    groups = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = materialised(groups.select("length", "salt", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")), "lengths")
    counts = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    full = counts.pop(window, 0)
    placed = ([(window, 0, full, 0, 0)] if full else []) + best_fit(counts, window, full)
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    for length, first, end, sequence, offset in placed:
        by_length.setdefault(length, []).append((first, end, sequence, offset))
    placement = spark.createDataFrame(
        [(length, parts) for length, parts in by_length.items()],
        "length long, parts array<struct<first:long,end:long,sequence:long,offset:long>>")

    order = Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32")
    ranked = salted.withColumn("in_salt", F.row_number().over(order) - 1)
    ranked = ranked.join(groups.select("length", "salt", "base"), ["length", "salt"]).withColumn("rank", F.col("base") + F.col("in_salt"))
    part = F.filter("parts", lambda p: (p["first"] <= F.col("rank")) & (F.col("rank") < p["end"]))[0]
    return ranked.join(F.broadcast(placement), "length").withColumn("part", part).select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("part")["sequence"] + F.col("rank") - F.col("part")["first"]).alias("sequence_id"), F.col("part")["offset"].alias("offset"))


def op5_packing(spark, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))
