"""Order MinHash: minimal occurrence-numbered k-mers in the order of the text, hashed to signatures sensitive to edit distance."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import bounded_batches, materialised, table
from firmament.llm.substring_dedup import mixed

#: Code points of a k-mer, k-mers of a tuple, tuples of a fingerprint (a power of two).
WIDTH, LENGTH, BINS = 9, 2, 64
#: k-mers of a bin that are looked at first; all are if a bin has fewer than ``LENGTH`` among them.
FIRST = 16
_FACTOR, _NUMBER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def kmers(points: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """64-bit hash of every k-mer: a polynomial in the code points, mixed. A shorter text is one k-mer."""
    width = min(width, len(points))
    if not width:
        return np.empty(0, np.uint64)
    value = points.astype(np.uint64) + np.uint64(1)
    n, out = len(points) - width + 1, np.full(len(points) - width + 1, width, np.uint64)
    for i in range(width):
        out *= _FACTOR
        out += value[i:i + n]
    return mixed(out)


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """How many equal k-mers stand before each, in the order of the text."""
    n = len(hashes)
    places = max(1, int(n - 1).bit_length())
    if places <= 24:  # one sort of k-mer and place in one number; 40 bits tell the k-mers of a text of this size apart
        low = np.uint64((1 << places) - 1)
        order = np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64))
        at, kind = (order & low).astype(np.int64), order & ~low
    else:
        at = np.argsort(hashes, kind="stable")
        kind = hashes[at]
    starts = np.concatenate([[True], kind[1:] != kind[:-1]]) if n else np.empty(0, bool)
    out = np.empty(n, np.int64)
    out[at] = np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    return out


def fingerprint(text: str, width: int = WIDTH, length: int = LENGTH, bins: int = BINS) -> np.ndarray:
    """A number from 1 to 65535 for each bin, 0 where no k-mer fell into it.

    A k-mer with its occurrence number has one random rank, whose upper bits name its bin. The ``length`` smallest of a bin, put back
    in the order of the text, are hashed as a tuple: it is kept by an edit elsewhere, and lost when its k-mers change places.
    """
    hashes = kmers(code_points(text), width)
    out = np.zeros(bins, np.uint16)
    if not len(hashes):
        return out
    rank = mixed(hashes + occurrences(hashes).astype(np.uint64) * _NUMBER)
    shift = np.uint64(64 - (bins.bit_length() - 1))
    rest = (np.uint64(1) << shift) - np.uint64(1)
    chosen = np.arange(len(rank))
    if len(rank) > bins * FIRST * 2:
        chosen = np.flatnonzero((rank & rest) < np.uint64(int(rest) * bins * FIRST // len(rank)))
        if np.bincount((rank[chosen] >> shift).astype(np.int64), minlength=bins).min() < length:
            chosen = np.arange(len(rank))
    chosen = chosen[np.argsort(rank[chosen], kind="stable")]
    bin_of = (rank[chosen] >> shift).astype(np.int64)
    first = np.searchsorted(bin_of, np.arange(bins))
    ends = np.append(first[1:], len(bin_of))
    places = np.full((bins, length), np.iinfo(np.int64).max)
    for j in range(length):
        held = first + j < ends
        places[held, j] = chosen[first[held] + j]
    places.sort(axis=1)
    found = np.zeros(bins, np.uint64)
    for j in range(length):
        held = places[:, j] < len(rank)
        found[held] = mixed(found[held] * _FACTOR + hashes[places[held, j]] + np.uint64(j + 1))
    full = ends > first
    out[full] = (found[full] % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those that either has filled; 1 if neither has any."""
    filled = int(((a != 0) | (b != 0)).sum())
    return int(((a == b) & (a != 0)).sum()) / filled if filled else 1.0


def spelt(mark: np.ndarray) -> str:
    return mark.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by as many of the first of ``following``, or all it has."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


FOUND = pa.schema([("id", pa.string()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                   ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                   ("task", pa.int64()), ("place", pa.int8()), ("text", pa.string())])
#: A document with all it needs, and a task's first and last document, whose texts travel on.
DONE, OPENING, CLOSING = 0, 1, 2


def finished(doc_id, text: str, mark: np.ndarray, following: str, next_mark: np.ndarray) -> tuple:
    new = edited(text, following)
    new_mark = mark if new == text else next_mark if new == following else fingerprint(new)
    return (doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), spelt(mark), spelt(new_mark), likeness(mark, new_mark),
            likeness(mark, next_mark))


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FOUND, strict=True)], schema=FOUND)


def in_order(batches):
    """Task function: documents of one range in their order, each compared with its edit and the next one. The task's last
    document awaits the first of a later task, and both go on as they are."""
    task, held = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held is None:
                rows.append((None,) * 7 + (task, OPENING, text))
                held = doc_id, text, fingerprint(text)
                continue
            mark = held[2] if text == held[1] else fingerprint(text)
            rows.append((*finished(*held, text, mark), task, DONE, None))
            held = doc_id, text, mark
        if rows:
            yield batch_of(rows)
    if held is not None:
        yield batch_of([(held[0],) + (None,) * 6 + (task, CLOSING, held[1])])


def across(batches):
    """Task function: the last document of each task with the first of the next one that has any."""
    for batch in batches:
        rows = [(*finished(doc_id, text, fingerprint(text), following, fingerprint(following)), None, DONE, None)
                for doc_id, text, following in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
        if rows:
            yield batch_of(rows)


def order_minhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit, and how alike they are: ``id_col, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edit replaces the last quarter of a text's code points (rounded down) by as many of the first of the next document, or all
    of it. Next is the next larger id; rows that repeat an id follow each other by a hash of their texts, documents without id come
    last, and the first follows the last. A single document follows itself. Null texts are empty; an empty text has no k-mers, a
    fingerprint of zeros, and is wholly like another empty one. A text shorter than a k-mer is one k-mer. Equal texts have equal
    fingerprints; an empty table gives no rows. Other columns are not looked at.

    All texts are dealt once, by ranges of id, text hash and row, so that rows of one id spread too. A task reads its range in order with
    two documents in hand; only the first and last text of each task travel on, numbered over the tasks that have documents.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumns({"none": F.col("id").isNull(), "mark": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    key = ["none", "id", "mark", "row"]
    dealt = texts.repartitionByRange(*key).sortWithinPartitions(*key).select(F.col("id").cast("string").alias("id"), "text")
    schema = ("id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
              "near_next double, task long, place tinyint, text string")
    found = materialised(dealt.mapInArrow(in_order, schema), "order-minhash")

    # One row a task: its number among the tasks that have documents, and that of the one before it, round from the last to the first.
    opening = found.where(F.col("place") == OPENING)
    tasks = sorted(r.task for r in opening.select("task").collect())
    after = {a: b for a, b in zip(tasks, [*tasks[1:], *tasks[:1]])}
    links = spark.createDataFrame(list(after.items()), "task long, next long")
    closing = found.where(F.col("place") == CLOSING).select("task", "id", "text").join(links, "task")
    ends = closing.join(opening.select(F.col("task").alias("next"), F.col("text").alias("following")), "next")
    ends = ends.select("id", "text", "following").mapInArrow(across, schema)
    columns = [F.col("id").cast(kind).alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return found.where(F.col("place") == DONE).unionByName(ends).select(*columns)


def op12_order_minhash(spark, folder: str) -> DataFrame:
    return order_minhash(table(spark, folder, "documents"))
