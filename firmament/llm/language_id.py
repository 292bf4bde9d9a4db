"""Language ID by mixture inference: each document's language shares by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import bounded_batches, is_held_out, table

UNKNOWN = "und"
#: Features: byte trigrams of the lower-cased text, hashed.
FEATURES = 1 << 15
_LETTER = regex.compile(r"\p{L}")


def features(data: bytes) -> np.ndarray:
    """Feature of each three bytes that follow each other."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    gram = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (gram * np.uint32(2654435761)) >> np.uint32(17)


def gram_counts(text: str) -> np.ndarray:
    """How often each feature occurs in a text of any length, a blank at either end."""
    data, counts = f" {text.lower()} ".encode(), np.zeros(FEATURES, np.int64)
    for i in range(0, len(data) - 2, 1 << 20):
        counts += np.bincount(features(data[i:i + (1 << 20) + 2]), minlength=FEATURES)
    return counts


def counts_by_language(batches):
    """Task function: feature counts of the task's texts per language."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            totals[lang] = totals.get(lang, 0) + gram_counts(text)
    for lang, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                                         names=["lang", "feature", "n"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = 20_000,
          smoothing: float = 0.5, most_languages: int = 256) -> tuple[list[str], np.ndarray]:
    """Languages and log-likelihoods of the features in each, from documents that aren't held out and have an id and a language.

    The ``most_languages`` with the most such documents are learned (ties: by name), which bounds the model.
    At most about ``rows`` documents per language, chosen by the hash of their id and text, are read (the documented bound of
    the sample; copies of one text are drawn one by one). Their counts, not their texts, reach the driver: ``FEATURES`` per language.
    """
    known = docs.where(F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()}
    if not sizes:
        return [], np.zeros((0, FEATURES))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows / n))])
    luck = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_003)) / 1_000_003
    sample = known.where(luck < share[F.col("lang")]).select("lang", "text")
    counted = sample.mapInArrow(counts_by_language, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    languages = sorted(sizes)
    counts = np.zeros((len(languages), FEATURES))
    for r in counted.collect():
        counts[languages.index(r.lang), r.feature] = r.n
    counts += smoothing
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True))


def shares_of(likelihood: np.ndarray, weights: np.ndarray, rounds: int = 30, tolerance: float = 1e-4) -> tuple[np.ndarray, float]:
    """Expectation-maximisation: shares of the languages (columns) that best explain weighted n-grams (rows), and the log-likelihood."""
    shares = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    total = weights.sum()
    for _ in range(rounds):
        joint = likelihood * shares
        mix = joint.sum(axis=1)
        new = (weights / mix) @ joint / total
        moved = np.abs(new - shares).max()
        shares = new
        if moved < tolerance:
            break
    return shares, float(weights @ np.log(likelihood @ shares))


def mixture(counts: np.ndarray, logs: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray, float]:
    """Languages of a document, their shares, and by how much they explain it better than even chance, per n-gram.

    Sets grow by the language with the largest share in the mixture of all; a set's log-likelihood is penalised by
    ``penalty`` per language times the logarithm of the number of n-grams (n-grams overlap, so a plain penalty is too small).
    """
    at = np.flatnonzero(counts)
    weights, log = counts[at].astype(float), logs[:, at]
    n = weights.sum()
    single = log @ weights
    best = int(single.argmax())
    chosen, shares, score = [best], np.ones(1), single[best] - penalty * np.log(n + 1)
    if len(logs) > 1:
        likelihood = np.exp(log).T
        every, _ = shares_of(likelihood, weights, rounds=12, tolerance=1e-2)
        order = [best, *[int(i) for i in np.argsort(-every, kind="stable") if i != best]]
        for k in range(2, len(order) + 1):
            if every[order[k - 1]] * n < penalty:
                break
            new, fit = shares_of(likelihood[:, order[:k]], weights)
            if fit - k * penalty * np.log(n + 1) <= score:
                break
            chosen, shares, score = order[:k], new, fit - k * penalty * np.log(n + 1)
    return chosen, shares, float((score + n * np.log(len(logs[0]))) / n)


def predictions(languages: list[str], logs: np.ndarray, penalty: float):
    """Task function: language set, leading language and its share for each text."""
    def run(batches):
        for batch in batches:
            leads, scores, sets, gains = [], [], [], []
            for text in batch.column(2).to_pylist():
                lead, score, listed, gain = UNKNOWN, 0.0, [], None
                if text and languages and _LETTER.search(text):
                    chosen, shares, gain = mixture(gram_counts(text), logs, penalty)
                    listed = sorted(({"lang": languages[i], "share": float(s)} for i, s in zip(chosen, shares, strict=True)),
                                    key=lambda x: (-x["share"], x["lang"]))
                    lead, score = listed[0]["lang"], min(1.0, listed[0]["share"])
                leads.append(lead)
                scores.append(score)
                sets.append(listed)
                gains.append(gain)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(leads, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(sets, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))), pa.array(gains, pa.float64())],
                names=["id", "held_out", "lang_pred", "score", "languages", "gain"])
    return run


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = 20_000,
                penalty: float = 8.0) -> DataFrame:
    """Language of each document: ``id_col, held_out, lang_pred, score, languages, gain``.

    ``languages`` is the set selected by penalised likelihood with its shares; ``lang_pred`` has the largest share, which
    is the score. ``gain`` is the mean log-likelihood per n-gram above even chance. Null texts, texts without a letter, and all
    texts where there is nothing to learn from are ``und`` with score 0 and no gain. Whole texts are read; rows whose id, language
    or text is null teach nothing; rows that repeat an id each get a row. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    languages, logs = learn(docs, id_col, text_col, lang_col, rows)
    texts = docs.select(F.col(id_col).alias("id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(
        predictions(languages, logs, penalty),
        f"id {kind}, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>, gain double",
    ).withColumnRenamed("id", id_col)


def with_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = 20_000,
                  penalty: float = 8.0) -> DataFrame:
    """The documents, all columns as they were, without those that have no language by ``language_id``.

    Rejected are the ``und`` alone, so short texts stay whatever their gain. The rows pass through one task each, so nothing
    is joined or shuffled.
    """
    bounded_batches(docs.sparkSession)
    languages, logs = learn(docs, id_col, text_col, lang_col, rows)
    at = docs.columns.index(text_col)

    def run(batches):
        predict = predictions(languages, logs, penalty)
        for batch in batches:
            given = pa.RecordBatch.from_arrays([batch.column(at)] * 3, names=["id", "held_out", "text"])
            for found in predict(iter([given])):
                yield batch.filter(pa.array([lead != UNKNOWN for lead in found.column(2).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_language_id(spark, folder: str) -> DataFrame:
    return language_id(table(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score", "languages")
