"""Spelling variants: words that differ by one character, found in the sorted rotations of terminator-marked words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import LOWER, UPPER, bounded_batches, byte_texts, materialised, table

FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Words that a task counts before it passes the counts on.
HELD = 400_000
#: Marks a word's end; no word holds it.
END = "$"


def noisy(run: str, prefix: int, every: int) -> str:
    """The run, without one code point if the checksum that goes on from ``prefix`` is divisible by ``every`` (0: never)."""
    if every:
        h = zlib.crc32(run.encode(), prefix)
        if h % every == 0:
            at = h % len(run)
            return run[:at] + run[at + 1:]
    return run


def word_counts(least_length: int, every: int):
    """Task function: the task's words with their numbers of occurrences."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch, texts in byte_texts(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs.findall((text or b"").translate(FOLD).decode())).items():
                    word = noisy(word, prefix, every)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > HELD:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)
    return run


def rotations(batches):
    """Task function: every rotation of each marked word, under the prefix that all words share which differ in what the row skips.

    A rotation that ends in a letter stands under itself without that letter, which is ``edge``: words that share it differ by a
    replacement there. Each rotation of the marked word also stands whole, with no edge: a word under it as a prefix has one letter
    more. ``tail`` marks the last letter of a run of equal ones: taking out any letter of a run gives one word, counted once.
    """
    for batch in batches:
        keys, edges, tails, counts = [], [], [], []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for i, letter in enumerate(word):
                rest = word[i + 1:]
                keys += (rest + END + word[:i], word[i:] + END + word[:i])
                edges += (letter, "")
                tails += (not rest.startswith(letter), False)
            keys.append(END + word)
            edges.append("")
            tails.append(False)
            counts += [n] * (2 * len(word) + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(edges, pa.string()), pa.array(tails, pa.bool_()), pa.array(counts, pa.int64())],
            names=["key", "edge", "tail", "n"])


def word_at(key: str, edge: str) -> str:
    rest, _, start = key.partition(END)
    return start + edge + rest


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def neighbours(group: list[tuple]) -> list[tuple]:
    """Rows (word, near words here, the best of them) of one prefix range; entries (edge, tail, n) are one per letter at most.

    The best is that of the largest n, ties: the smallest word. Two leaders are enough to know everyone's best other.
    """
    key = group[0][0]
    entries = sorted((-n, word_at(key, edge), bool(edge), tail) for _, edge, tail, n in group)
    cut = [e for e in entries if e[2]]
    whole = [e for e in entries if not e[2]]
    longer = [e for e in cut if e[3]]
    found = []
    for e in cut:
        near, best = len(cut) - 1, cut[0] if cut[0] is not e else cut[1] if len(cut) > 1 else None
        if e[3] and whole:
            near, best = near + 1, min(best, whole[0]) if best else whole[0]
        if near:
            found.append((e[1], near, -best[0], best[1]))
    if whole and longer:
        found.append((whole[0][1], len(longer), -longer[0][0], longer[0][1]))
    return found


def scanned(batches):
    """Task function: scans sorted rotations range by range. A range of one row has no neighbours and is skipped in Arrow."""
    held: list[tuple] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(0)
        same = pc.equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False).tolist() if n > 1 else []
        first = bool(held) and keys[0].as_py() == held[0][0]
        wanted = [i for i, (a, b) in enumerate(zip([first, *same], [*same, True], strict=True)) if a or b]
        rows = list(zip(*[c.to_pylist() for c in batch.take(pa.array(wanted, pa.int64())).columns], strict=True))
        out = []
        for row in rows:
            if held and row[0] != held[0][0]:
                out += neighbours(held)
                held = []
            held.append(row)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), NEAR, strict=True)], schema=NEAR)
    if held and (out := neighbours(held)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), NEAR, strict=True)], schema=NEAR)


def roots(forms: DataFrame) -> DataFrame:
    """Last of the chain from each word that has a form: ``word, root``, from ``word, form``, which has no cycles.

    Every round joins the words with where their places have got to, which doubles the steps gone: the rounds grow with the
    logarithm of the longest chain. Each is written to the shared folder.
    """
    chains = forms.select("word", F.col("form").alias("root"))
    while True:
        on = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialised(chains.join(on, "root", "left").select("word", "root", "next"), "spelling-roots")
        chains = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.where(F.col("next").isNotNull()).isEmpty():
            return chains


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_n: int = 3,
                      factor: int = 2, every: int = 0) -> DataFrame:
    """Words with their near words and the form each is a variant of: ``word, form, root, n, n_near, form_n``.

    Words are maximal runs of ``[A-Za-z\u00C0-\u00FF]``, A-Z lower-cased, of at least ``least_length`` code points and ``least_n``
    occurrences. ``every`` plants slips: a run whose crc32 of ``<id>:<run>`` it divides loses a code point first (0: none). Two
    words are near if they differ by one inserted, deleted or replaced code point. A word's form is its near word of largest
    ``n`` (ties: the smallest), if that is at least ``factor`` times its own; its root is where the forms lead, or itself.

    Words are counted in the tasks before they are shuffled. Every rotation of a marked word is sorted under the prefix that
    skips the edited letter, and each range of equal prefixes is scanned once. A range holds a word per letter and one more, at most
    95 of this alphabet, and is judged by its two leaders, so no pairs are emitted.

    Null and empty texts have no words; a null id counts as empty text in the checksum. Rows that repeat count each. An empty table
    gives no rows. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = texts.mapInArrow(word_counts(least_length, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = materialised(counts.where(F.col("n") >= least_n), "spelling-words")
    turned = words.mapInArrow(rotations, "key string, edge string, tail boolean, n long").repartition("key").sortWithinPartitions("key")
    near = turned.mapInArrow(scanned, "word string, n_near long, best_n long, best string").groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best"))
    near = words.join(near, "word", "left").withColumn("fits", -F.col("best.n") >= factor * F.col("n"))
    near = materialised(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("fits"), F.col("best.word")).alias("form"),
        F.when(F.col("fits"), -F.col("best.n")).alias("form_n")), "spelling-forms")
    ends = roots(near.where(F.col("form").isNotNull()))
    return near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"), every=97)
