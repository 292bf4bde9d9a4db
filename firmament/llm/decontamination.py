"""Benchmark decontamination by a prefix-filtered set join over word shingles."""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import ascii_lower, bounded_batches, byte_texts, materialised, table

#: Letters and digits of ASCII and all other characters make words, as UTF-8 bytes: A-Z in lower case, the rest a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def shingles_in(words: list[bytes], vocabulary: dict[int, frozenset]) -> set[tuple[bytes, ...]]:
    """Shingles of the vocabulary (by number of words) that occur among ``words``."""
    found: set[tuple[bytes, ...]] = set()
    for k, known in vocabulary.items():
        found |= known.intersection(zip(*[words[i:] for i in range(k)]))
    return found


def by_length(shingles: list[str]) -> dict[int, frozenset]:
    split = [tuple(s.encode().split(b" ")) for s in shingles]
    return {k: frozenset(s for s in split if len(s) == k) for k in sorted({len(s) for s in split})}


def document_counts(vocabulary: dict[int, frozenset]):
    """Task function: in how many texts of the task each shingle occurs."""
    def run(batches):
        counts: Counter = Counter()
        for _, texts in byte_texts(batches):
            for text in texts:
                if text:
                    counts.update(shingles_in(text.translate(FOLD).split(), vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array([b" ".join(s).decode() for s in counts], pa.string()),
                                          pa.array(counts.values(), pa.int64())], names=["shingle", "documents"])
    return run


HIT = pa.schema([("text_sha256", pa.string()), ("n_words", pa.int64()), ("shingle", pa.string()), ("position", pa.int64()),
                 ("first", pa.int64()), ("around", pa.list_(pa.string()))])


def prefix_hits(vocabulary: dict[int, frozenset], reach: int):
    """Task function: every place of a prefix shingle with the words around it. Equal texts of a batch are read once."""
    def run(batches):
        for _, texts in byte_texts(batches):
            rows = []
            for text in set(texts):
                words = text.translate(FOLD).split() if text else []
                wanted = shingles_in(words, vocabulary)
                if not wanted:
                    continue
                key = hashlib.sha256(text).hexdigest()
                for k in {len(s) for s in wanted}:
                    for at, shingle in enumerate(zip(*[words[i:] for i in range(k)])):
                        if shingle in wanted:
                            first = max(0, at - reach + 1)
                            around = [w.decode() for w in words[first:at + reach]]
                            rows.append((key, len(words), b" ".join(shingle).decode(), at, first, around))
                            if len(rows) == 5000:
                                yield _batch(rows)
                                rows = []
            if rows:
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), HIT, strict=True)], schema=HIT)


def word_counts(batches):
    """Task function: number of words and digest of each text, beside its id."""
    for batch, texts in byte_texts(batches):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t.translate(FOLD).split()) if t else 0 for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t or b"").hexdigest() for t in texts], pa.string())], names=["id", "n_words", "text_sha256"])


def contaminated_texts(docs: DataFrame, items: DataFrame, text_col: str, item_col: str, item_text_col: str, window: int = 13,
                       shingle: int = 3, block: int = 200_000) -> DataFrame:
    """What each text that holds a window of an item is hit by: ``text_sha256, n_hit, item_ids``.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. Its shingles of ``shingle`` words
    (or all words of a shorter window) are ordered by the number of documents they occur in. A text that contains the
    window contains all of them, so its rarest shingle is the only prefix token needed: texts are joined with windows on
    it, cut by the bounds on length and position, and the words at that place are compared with the window's. A window with
    a shingle that occurs nowhere is dropped at once.

    The shingles that a pass over the texts looks up are at most ``block``, which bounds a worker's memory; more
    items mean more passes.
    """
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(item_text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    spans = F.when(F.size("words") < window, F.array("words")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))), lambda i: F.slice("words", i + 1, window)))
    listed = items.select(F.col(item_col).cast("string").alias("item_id"), words.alias("words")).where(F.size("words") > 0)
    held = materialised(listed.select("item_id", F.explode(F.array_distinct(spans)).alias("span")).select(
        "item_id", F.array_join("span", " ").alias("window"), F.size("span").alias("n")), "item-windows")

    windows = held.select("window", "n").distinct()
    k = F.least("n", F.lit(shingle))
    parts = F.transform(F.sequence(F.lit(0), F.col("n") - k), lambda i: F.struct(
        i.alias("offset"), F.array_join(F.slice(F.split("window", " "), i + 1, k), " ").alias("shingle")))
    tokens = materialised(windows.select("window", "n", F.inline(parts)), "item-shingles")
    texts = docs.select(F.col(text_col).cast("string").alias("text"))

    counted = None
    for vocabulary in _blocks(tokens, block):
        part = texts.mapInArrow(document_counts(vocabulary), "shingle string, documents long")
        counted = part if counted is None else counted.unionByName(part)
    if counted is None:
        return held.sparkSession.createDataFrame([], "text_sha256 string, n_hit long, item_ids array<string>")
    rarity = counted.groupBy("shingle").agg(F.sum("documents").alias("documents"))
    ordered = tokens.join(rarity, "shingle", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("documents", F.lit(0)).alias("documents"), "offset", "shingle")).alias("rarest"))
    prefixes = materialised(ordered.where("rarest.documents > 0").select("window", "n", "rarest.shingle", "rarest.offset"), "item-prefixes")

    found = held.sparkSession.createDataFrame([], "text_sha256 string, n_words long, shingle string, position long, first long, around array<string>")
    for vocabulary in _blocks(prefixes, block):
        found = found.unionByName(texts.mapInArrow(prefix_hits(vocabulary, window), found.schema))
    start = F.col("position") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    same = F.array_join(F.slice("around", (start - F.col("first") + 1).cast("int"), F.col("n")), " ") == F.col("window")
    hits = materialised(found.join(prefixes, "shingle").where(inside).where(same).select(
        "text_sha256", start.alias("start"), (start + F.col("n")).alias("end"), "window").distinct(), "window-hits")

    earlier = Window.partitionBy("text_sha256").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0))))
    covered = hits.select("text_sha256", "start", "end").distinct().withColumn("fresh", fresh).groupBy("text_sha256").agg(F.sum("fresh").alias("n_hit"))
    named = hits.select("text_sha256", "window").distinct().join(held.select("window", "item_id"), "window").groupBy("text_sha256").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    return covered.join(named, "text_sha256")


def _blocks(tokens: DataFrame, block: int):
    """The distinct shingles in blocks of about ``block``, each a vocabulary for the tasks of one pass."""
    shingles = tokens.select("shingle").distinct()
    blocks = -(-shingles.count() // block)
    for i in range(blocks):
        rows = shingles.where(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == i).collect()
        if rows:
            yield by_length([r.shingle for r in rows])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = 3, share: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block: int = 200_000) -> DataFrame:
    """Which documents hold windows of benchmark items.

    Returns one row per document: ``id_col, n_words, n_hit, n_items, items_sha256, contaminated, item_ids, text_sha256``.
    ``n_hit`` counts the document's words inside any window's occurrence; a document is contaminated if that is at least
    one in ``share`` of its words (and not 0). ``item_ids`` are the items with occurring windows, sorted as strings; an
    item without id hits words but isn't listed. Null and empty texts have no words; items without words have no windows.
    Rows that repeat, and null ids, are judged by their text. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    sizes = texts.mapInArrow(word_counts, f"id {kind}, n_words long, text_sha256 string")
    hit = materialised(contaminated_texts(docs, items, text_col, item_col, item_text_col, window, shingle, block), "contaminated")
    n_hit, items_hit = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("item_ids", F.array().cast("array<string>"))
    return sizes.join(hit, "text_sha256", "left").select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items_hit).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_hit, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), items_hit.alias("item_ids"), "text_sha256")


def op1_decontamination(spark, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
