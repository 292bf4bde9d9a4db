"""Substring dedup: a count-min sketch of all windows, then exact grouping of those that it estimates repeated."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import bounded_batches, materialised, table

DEPTH = 2
#: Counters of a sketch row that are summed together: these at least, or one of ``CHUNKS`` of all, up to ``MOST``.
CHUNK, CHUNKS, MOST = 1 << 22, 1 << 10, 1 << 28
#: Bytes of text of a part, whose windows a task holds at once (whole documents, so that a longer one makes a longer part).
PART = 3 << 20
#: Bytes that are hashed at once.
SLICE = 1 << 20
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit mixing, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """128-bit hash of each word, as two rows of numbers: sums of bytes times a random factor of their place, then mixed."""
    out = np.empty((2, len(starts)), np.uint64)
    if not len(starts):
        return out
    places = np.arange(1, lengths.max() + 1, dtype=np.uint64)
    factors = [mixed(places * m) for m in _MULTIPLIERS]
    ends = np.cumsum(lengths)
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + SLICE, SLICE)))
    for a, b in zip(cuts, [*cuts[1:], len(starts)]):
        if a < b:
            first = ends[a:b] - lengths[a:b] - (ends[a] - lengths[a])
            place = np.arange(first[-1] + lengths[b - 1]) - np.repeat(first, lengths[a:b])
            value = data[place + np.repeat(starts[a:b], lengths[a:b])].astype(np.uint64) + np.uint64(1)
            for i, factor in enumerate(factors):
                out[i, a:b] = mixed(np.add.reduceat(value * factor[place], first) + lengths[a:b].astype(np.uint64))
    return out


def window_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of windows of each text, and 128-bit hashes of all of them: two polynomials in the words' hashes, by doubling."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    solid = np.zeros(len(data) + 2, bool)
    np.logical_not(_BLANK[data], out=solid[1:-1])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts = edges[::2]
    power = word_hashes(data, starts, edges[1::2] - starts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    words = np.diff(np.searchsorted(starts, ends), prepend=0)
    sizes = np.maximum(words - width + 1, 0)
    n = len(starts) - width + 1
    if n <= 0:
        return sizes, np.empty((2, 0), np.uint64)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), words)
    inside = text[:n] == text[width - 1:]
    return sizes, np.stack([_windows(row, m, width, n)[inside] for row, m in zip(power, _MULTIPLIERS)])


def _windows(power: np.ndarray, factor: np.uint64, width: int, n: int) -> np.ndarray:
    span, out, covered, rest = 1, None, 0, width
    while rest:
        if rest & 1:
            part = power[covered:covered + n]
            out = part if out is None else out * factor + part
            covered += span
        rest >>= 1
        if rest:
            power = power[:-span] * factor + power[span:]
            factor, span = np.multiply(factor, factor, dtype=np.uint64), 2 * span
    return out


def windows_of(texts: pa.Table, width: int, key: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts of one part that are not empty: document keys, row numbers, windows per text, window hashes."""
    data = texts.column("text").cast(pa.binary()).to_pylist()
    some = [i for i, t in enumerate(data) if t]
    held = [data[i] for i in some]
    ids = texts.column("id").to_pylist()
    rows = texts.column("row").to_numpy()[some] if some else np.empty(0, np.int64)
    sizes, hashes = window_hashes(held, width) if held else (np.empty(0, np.int64), np.empty((2, 0), np.uint64))
    return keys_of([ids[i] for i in some], held, key), rows, sizes, hashes


#: Place of documents without id: behind all others.
NO_ID = (1 << 63) - 1
#: Key of a document, in the order of the corpus: the id where ids tell all rows apart, else also whether there is none and 128 bits of its text.
UNIQUE = np.dtype([("id", "<i8")])
MARKED = np.dtype([("id", "<i8"), ("none", "u1"), ("mark", "<u8"), ("more", "<u8")])


def keys_of(ids: list, texts: list, key: np.dtype) -> np.ndarray:
    out = np.empty(len(ids), key)
    out["id"] = [NO_ID if i is None else i for i in ids]
    if key == MARKED:
        out["none"] = [i is None for i in ids]
        out["mark"] = [xxhash.xxh3_64_intdigest(t or b"") for t in texts]
        out["more"] = [xxhash.xxh64_intdigest(t or b"") for t in texts]
    return out


def apart(rows: np.ndarray, fields: tuple) -> np.ndarray:
    """Which rows differ from the one before them in any of the fields; the first does."""
    out = np.ones(len(rows), bool)
    out[1:] = np.any([rows[f][1:] != rows[f][:-1] for f in fields], axis=0)
    return out


def bucket(hashes: np.ndarray, counters: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(counters)) >> np.uint64(32)


def packed(values: np.ndarray) -> bytes:
    """Ascending numbers as steps; their upper bytes, which are mostly zero, are compressed."""
    steps = np.diff(values, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
    return steps[:, 0].tobytes() + zlib.compress(steps[:, 1:].T.tobytes(), 1)


def unpacked(data: bytes, n: int) -> np.ndarray:
    steps = np.empty((n, 4), np.uint8)
    steps[:, 0] = np.frombuffer(data, np.uint8, n)
    steps[:, 1:] = np.frombuffer(zlib.decompress(data[n:]), np.uint8).reshape(3, n).T
    return np.cumsum(steps.reshape(-1).view("<u4"), dtype=np.int64)


def counted(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted counters: which there are, and how often."""
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.empty(0, np.int64)
    return at[starts].astype(np.int64), np.diff(np.append(starts, len(at)))


SKETCH = pa.schema([("row", pa.int32()), ("chunk", pa.int64()), ("part", pa.int64()), ("once_n", pa.int32()), ("once", pa.binary()),
                    ("twice_n", pa.int32()), ("twice", pa.binary())])
REPLY = pa.schema([("part", pa.int64()), ("row", pa.int32()), ("chunk", pa.int64()), ("repeated", pa.binary())])


def rows_as(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)] if rows else [[]] * len(schema), schema=schema)


def sketch(width: int, counters: int, chunk: int):
    """Group function: a part's sketch, counters saturating at 2: per row and chunk those at 1 and those at 2."""
    def run(texts):
        part, out = texts.column("part")[0].as_py(), []
        hashes = windows_of(texts, width, UNIQUE)[3]
        for row in range(DEPTH):
            at, n = counted(np.sort(bucket(hashes[row], counters)))
            cuts = np.flatnonzero(np.diff(at // chunk, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(at)]):
                inside, often = at[a:b] % chunk, n[a:b] > 1
                out.append((row, int(at[a] // chunk), part, int((~often).sum()), packed(inside[~often]), int(often.sum()), packed(inside[often])))
        return rows_as(out, SKETCH)
    return run


def summed(chunk: int):
    """Group function: the parts' counters of one chunk, added up. Each part is told of its counters at 1 which are 2 or more in all."""
    def run(parts):
        counts = np.zeros(chunk, np.uint8)
        for name, times in (("once", 1), ("twice", 2)):
            for data, n in zip(parts.column(name).to_pylist(), parts.column(f"{name}_n").to_pylist(), strict=True):
                at = unpacked(data, n)
                counts[at] = np.minimum(counts[at] + times, 2)
        row, number = parts.column("row")[0].as_py(), parts.column("chunk")[0].as_py()
        return rows_as([(part, row, number, np.packbits(counts[unpacked(data, n)] >= 2).tobytes()) for part, data, n in zip(
            parts.column("part").to_pylist(), parts.column("once").to_pylist(), parts.column("once_n").to_pylist(), strict=True) if n], REPLY)
    return run


def repeated(hashes: np.ndarray, counters: int, chunk: int, replies: list[tuple[int, bytes]]) -> np.ndarray:
    """Which of a part's windows one sketch row estimates repeated; ``replies`` has (chunk, bits) of that row."""
    at = bucket(hashes, counters)
    order = np.argsort(at, kind="stable")
    there, n = counted(at[order])
    often = n > 1
    once = np.flatnonzero(~often)
    sizes = np.bincount(np.unique(there[once] // chunk, return_inverse=True)[1]) if len(once) else []
    bits = [np.unpackbits(np.frombuffer(data, np.uint8), count=int(size)) for (_, data), size in zip(sorted(replies), sizes, strict=True)]
    often[once] = np.concatenate(bits) == 1 if bits else False
    out = np.empty(len(at), bool)
    out[order] = np.repeat(often, n)
    return out


def place_of(key: np.dtype) -> np.dtype:
    """A place: the row, the start."""
    return np.dtype([("row", "<i8"), ("start", "<u4")])


def entry_of(key: np.dtype) -> np.dtype:
    """A window at a place: 96 bits of its words, the document's key, the start, and where its text is."""
    rest = [("part", "<u4")] if key == UNIQUE else [("part", "<u4"), ("row", "<i8")]
    return np.dtype([("a", "<u8"), ("b", "<u4"), *key.descr, ("start", "<u4"), *rest])


OUT = pa.schema([("slot", pa.int64()), ("part", pa.int64()), ("entries", pa.binary())])
GONE = pa.schema([("part", pa.int64()), ("entries", pa.binary())])


def by_column(entries: np.ndarray) -> bytes:
    """Fields one after the other, each by its first bytes, second bytes and so on: upper bytes of small numbers are alike and compress."""
    return b"".join(np.ascontiguousarray(entries[f]).view(np.uint8).reshape(len(entries), -1).T.tobytes() for f in entries.dtype.names)


def of_columns(data: bytes, kind: np.dtype) -> np.ndarray:
    n, offset = len(data) // kind.itemsize, 0
    entries = np.empty(n, kind)
    for field in kind.names:
        width = kind[field].itemsize
        planes = np.frombuffer(data, np.uint8, n * width, offset).reshape(width, n)
        entries[field] = np.ascontiguousarray(planes.T).reshape(-1).view(kind[field])
        offset += n * width
    return entries


def dealt(entries: np.ndarray, slots: int) -> list[tuple]:
    """Rows (slot, no part, entries) of windows, by the slot of their hash."""
    slot = bucket(entries["a"], slots).astype(np.int64)  # entries are in the order of ``a``, and so of slots
    order = np.argsort(slot, kind="stable")
    entries, slot = entries[order], slot[order]
    cuts = np.flatnonzero(np.diff(slot, prepend=-1))
    return [(int(slot[a]), None, by_column(entries[a:b])) for a, b in zip(cuts, [*cuts[1:], len(entries)])]


def removed_rows(entries: np.ndarray, key: np.dtype) -> list[tuple]:
    """Rows (part, places) of what is removed, by the part of its text."""
    places = np.empty(len(entries), place_of(key))
    places["row"], places["start"] = entries["id" if key == UNIQUE else "row"], entries["start"]
    order = np.lexsort((places["start"], places["row"], entries["part"]))
    places, part = places[order], entries["part"][order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    return [(int(part[a]), by_column(places[a:b])) for a, b in zip(cuts, [*cuts[1:], len(places)])]


def in_order(entries: np.ndarray, key: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Entries by window and place in the corpus, and which of them are their window's first."""
    entries = entries[np.lexsort([entries[f] for f in reversed(("a", "b", *key.names, "start"))])]
    first = apart(entries, ("a", "b"))
    # Equal rows are one document: a tie for the first place is first too.
    lead = np.maximum.accumulate(np.where(first, np.arange(len(entries)), 0))
    tied = np.all([entries[f] == entries[f][lead] for f in (*key.names, "start")], axis=0) if len(entries) else first
    return entries, first | tied


def candidates(width: int, counters: int, chunk: int, slots: int, key: np.dtype):
    """Cogroup function: a part's windows that every sketch row estimates repeated.

    Of a window's places in one part only the first can be its first in the corpus. That one goes to the window's slot;
    the others are removed whatever the rest holds.
    """
    def run(texts, replies):
        if not texts.num_rows:
            return rows_as([], OUT)
        part = texts.column("part")[0].as_py()
        keys, rows, sizes, hashes = windows_of(texts, width, key)
        told: list[list] = [[] for _ in range(DEPTH)]
        for row, number, bits in zip(*[replies.column(c).to_pylist() for c in ("row", "chunk", "repeated")], strict=True):
            told[row].append((number, bits))
        keep = np.ones(hashes.shape[1], bool)
        for row in range(DEPTH):
            keep &= repeated(hashes[row], counters, chunk, told[row])
        at = np.flatnonzero(keep)
        doc = np.repeat(np.arange(len(keys)), sizes)[at]
        entries = np.empty(len(at), entry_of(key))
        entries["a"], entries["b"], entries["part"] = hashes[0, at], hashes[1, at], part
        for field in key.names:
            entries[field] = keys[field][doc]
        if key == MARKED:
            entries["row"] = rows[doc]
        entries["start"] = at - np.concatenate([[0], np.cumsum(sizes)])[doc]
        entries, first = in_order(entries, key)
        gone = [(part % slots, *r) for r in removed_rows(entries[~first], key)]
        return rows_as([*dealt(entries[first], slots), *gone], OUT)
    return run


def later_windows(key: np.dtype):
    """Group function: places of one slot that aren't their window's first, by part; what is removed already passes through."""
    def run(rows):
        known, data = rows.column("part").to_pylist(), rows.column("entries").to_pylist()
        out = [(p, d) for p, d in zip(known, data, strict=True) if p is not None]
        sent = [of_columns(d, entry_of(key)) for p, d in zip(known, data, strict=True) if p is None]
        if sent:
            entries, first = in_order(np.concatenate(sent), key)
            out += removed_rows(entries[~first], key)
        return rows_as(out, GONE)
    return run


KEPT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def without_removed(width: int):
    """Cogroup function: removes the words of a part's texts that their removed windows cover."""
    def run(texts, gone):
        if not texts.num_rows:
            return KEPT.empty_table()
        held = [of_columns(d, place_of(UNIQUE)) for d in gone.column("entries").to_pylist()]
        places = np.concatenate(held) if held else np.empty(0, place_of(UNIQUE))
        places = places[np.argsort(places["row"], kind="stable")]
        rows = texts.column("row").to_numpy()
        first, end = np.searchsorted(places["row"], rows), np.searchsorted(places["row"], rows, "right")
        totals, removed, digests, kept = [], [], [], []
        for text, a, b in zip(texts.column("text").cast(pa.binary()).to_pylist(), first.tolist(), end.tolist(), strict=True):
            words, away = text.split() if text else [], 0
            if b > a:
                edges = np.zeros(len(words) + 1, np.int64)
                at = np.unique(places["start"][a:b]).astype(np.int64)
                edges[at] += 1
                edges[at + width] -= 1
                covered = np.cumsum(edges[:-1]) > 0
                away = int(covered.sum())
                rest = b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c])
            else:
                rest = b" ".join(words)
            totals.append(len(words))
            removed.append(away)
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        return pa.table([texts.column("id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                         pa.array(kept, pa.binary()).cast(pa.string())], schema=KEPT)
    return run


def substring_dedup(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text", counters_per_byte: float = 0.5,
                    slot_bytes: int = 8 << 20) -> DataFrame:
    """Remove each word covered by a window of ``width`` words whose word sequence also starts earlier.

    Returns one row per document: ``id_col, n_words, n_removed, kept_sha256, kept``. Earlier is a smaller id, or the same
    document and a smaller start. Ids are whole numbers; documents without id come last. Rows that repeat an id are told
    apart by 128 bits of their text (and ordered by them), as those without id are; rows equal in both are one document and lose the same
    words. Null and empty texts have no words. An empty table gives no rows; other columns are not looked at.

    The texts are dealt once into parts of about ``PART`` bytes, which every step reads again. First pass: each part counts its windows in a
    count-min sketch of two rows whose counters stop at 2, ``counters_per_byte`` a byte at any size. The parts' counters travel
    as sparse lists, are summed chunk by chunk, and each part is told by one bit for each counter it sent once whether it is 2 or
    more in all; estimates are never too low. Second pass: windows that both rows estimate repeated are grouped
    exactly, by 96 bits of their words. A part sends one place per window, so a passage in a third of all documents is reduced
    before the shuffle. Nothing is collected or broadcast, so neither the driver nor a worker holds the sketch.

    Where ids are null or repeated, the texts are first written with row numbers, which deal them evenly.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    odd = texts.groupBy("id").count().where((F.col("count") > 1) | F.col("id").isNull()).limit(1).count()
    if odd:
        key, texts = MARKED, materialised(texts.withColumn("row", F.monotonically_increasing_id()), "substring-rows")
    else:
        key, texts = UNIQUE, texts.withColumn("row", F.col("id"))
    counters = int(max(1 << 16, size * counters_per_byte))
    chunk = min(MOST, max(CHUNK, -(-counters // CHUNKS)))
    slots = max(16, size // slot_bytes)

    # All steps take all columns of this, so that Spark deals the texts once and reads that again.
    parts = texts.select(F.pmod(F.xxhash64("row"), F.lit(max(16, size // PART))).alias("part"), "id", "row", "text").repartition("part")
    by_part = parts.groupBy("part")
    sketches = by_part.applyInArrow(sketch(width, counters, chunk), "row int, chunk long, part long, once_n int, once binary, twice_n int, twice binary")
    replies = sketches.groupBy("row", "chunk").applyInArrow(summed(chunk), "part long, row int, chunk long, repeated binary")
    found = by_part.cogroup(replies.groupBy("part")).applyInArrow(candidates(width, counters, chunk, slots, key), "slot long, part long, entries binary")
    gone = found.groupBy("slot").applyInArrow(later_windows(key), "part long, entries binary")
    kept = by_part.cogroup(gone.groupBy("part")).applyInArrow(
        without_removed(width), "id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return kept.withColumnRenamed("id", id_col)


def op2_substring_dedup(spark, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents")).drop("kept")
