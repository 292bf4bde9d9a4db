"""Toxicity from the nearest labelled examples, found exactly in a block-max inverted index of TF-IDF vectors."""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import bounded_batches, is_held_out, materialised, table
from firmament.llm.decontamination import FOLD

#: Examples of the index that share one bound per term.
BLOCK = 128
#: Blocks that are read first, before the k-th best similarity so far rules others out.
FIRST_BLOCKS = 2
#: A term that more than one in so many examples holds is common.
COMMON = 16
#: Texts that are searched at once.
AT_ONCE = 64
#: Scores that a task remembers, by text.
REMEMBERED = 50_000


def terms_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(FOLD).split() if text else []


class Sample(NamedTuple):
    """Labelled examples: id and label of each, and the terms of the i-th with their counts from ``starts[i]`` to ``starts[i + 1]``."""

    ids: list
    labels: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    counts: np.ndarray

    def only(self, chosen: np.ndarray) -> Sample:
        sizes = np.diff(self.starts)[chosen]
        at = spans(self.starts[:-1][chosen], sizes)
        return Sample([self.ids[i] for i in chosen.tolist()], self.labels[chosen], np.concatenate([[0], np.cumsum(sizes)]), self.terms[at], self.counts[at])

    def vectors(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(self.terms[a:b], self.counts[a:b]) for a, b in zip(self.starts, self.starts[1:])]


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def example_terms(batches):
    """Task function: id, label, and the distinct terms of each example with their counts."""
    for batch in batches:
        for doc_id, toxic, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            counts = sorted(Counter(terms_of(text)).items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id], pa.string()), pa.array([toxic], pa.int32()), pa.array([b" ".join(t for t, _ in counts)], pa.binary()),
                 pa.array([np.array([n for _, n in counts], "<u4").tobytes()], pa.binary())], names=["id", "toxic", "terms", "counts"])


def document_counts(vocabulary: dict[bytes, int]):
    """Task function: in how many of the task's texts each term of the vocabulary occurs, with all texts under -1."""
    def run(batches):
        held, total = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += 1
                held[[vocabulary[w] for w in set(terms_of(text)) if w in vocabulary]] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([total, *held[at].tolist()], pa.int64())], names=["term", "n"])
    return run


def relevance(sample: Sample, size: int) -> np.ndarray:
    """Square root of each term's chi-squared between its presence and the label: 0 where it tells nothing, and no term is cut."""
    label = np.repeat(sample.labels, np.diff(sample.starts))
    a, b = (np.bincount(sample.terms[label == y], minlength=size).astype(float) for y in (1, 0))
    bad = float(sample.labels.sum())
    good = len(sample.labels) - bad
    rows = bad + good
    spread = (a + b) * (rows - a - b) * bad * good
    return np.sqrt(np.divide(rows * (a * good - b * bad) ** 2, spread, out=np.zeros(size), where=spread > 0))


def weights(counts: tuple[tuple[int, int], ...], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights (1 + log tf) * weight of the term, scaled to length 1 (or all 0)."""
    terms, tf = np.array(counts, dtype=np.int64).reshape(-1, 2).T
    w = (1 + np.log(tf)) * weight[terms]
    length = np.linalg.norm(w)
    return terms, w / length if length > 0 else w


class BlockMaxIndex:
    """Inverted lists of examples, cut into segments by block of examples, each with the largest weight it holds.

    Examples are ordered by their heaviest term, so that a term is heavy in few blocks and bounds are tight. The lists of terms that
    more than one in ``COMMON`` examples holds are kept as whole rows, and several texts are multiplied with them at once.
    """

    def __init__(self, examples: list[tuple[tuple[int, int], ...]], weight: np.ndarray):
        rows = [weights(counts, weight) for counts in examples]
        heaviest = lambda t, w: (int(t[w.argmax()]), -w.max()) if len(t) else (-1, 0.0)
        self.order = np.array(sorted(range(len(rows)), key=lambda i: (*heaviest(*rows[i]), i)), np.int64)
        self.blocks = -(-len(rows) // BLOCK)
        self.room = self.blocks * BLOCK
        terms = np.concatenate([rows[i][0] for i in self.order]) if rows else np.empty(0, np.int64)
        held = np.concatenate([rows[i][1] for i in self.order]) if rows else np.empty(0)
        place = np.repeat(np.arange(len(rows)), [len(rows[i][0]) for i in self.order])
        some = held > 0
        terms, place, held = terms[some], place[some], held[some]
        often = np.bincount(terms, minlength=len(weight)) > max(BLOCK, len(rows) // COMMON)
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.whole = np.zeros((int(often.sum()), self.room))
        self.whole[self.row[terms[often[terms]]], place[often[terms]]] = held[often[terms]]
        order = np.flatnonzero(~often[terms])
        order = order[np.argsort(terms[order], kind="stable")]
        terms, self.place, self.held = terms[order], place[order], held[order]
        block = self.place // BLOCK
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])
        self.start = np.flatnonzero(new)
        self.size = np.diff(np.append(self.start, len(terms)))
        self.block = block[self.start]
        self.bound = np.maximum.reduceat(self.held, self.start) if len(terms) else np.empty(0)
        self.first = np.searchsorted(terms[self.start], np.arange(len(weight) + 1))
        self.begin = np.searchsorted(terms, np.arange(len(weight) + 1))

    def nearest(self, queries: list, weight: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
        """For each query the ``k`` examples of largest cosine above 0, best first (ties: the earlier example).

        The common terms' part of all cosines comes first. A block cannot hold more than its largest part so far and the bounds of its
        other segments add up to. The blocks that may hold most are read first, then all others that can still reach the k-th best.
        """
        if not self.blocks:
            return [[] for _ in queries]
        vectors = [weights(counts, weight) for counts in queries]
        dense = np.zeros((len(queries), len(self.whole)))
        for i, (terms, w) in enumerate(vectors):
            row = self.row[terms]
            dense[i, row[row >= 0]] = w[row >= 0]
        return [self._best(terms[self.row[terms] < 0], w[self.row[terms] < 0], part, k) if len(terms) else []
                for (terms, w), part in zip(vectors, dense @ self.whole, strict=True)]

    def _best(self, terms: np.ndarray, w: np.ndarray, part: np.ndarray, k: int) -> list[tuple[float, int]]:
        a, b = self.first[terms], self.first[terms + 1]
        segment, by_segment = spans(a, b - a), np.repeat(w, b - a)
        block = self.block[segment]
        reach = np.bincount(block, by_segment * self.bound[segment], self.blocks) + part.reshape(-1, BLOCK).max(axis=1)
        unread, least = reach > 1e-12, 0.0
        sims, ids = np.empty(0), np.empty(0, np.int64)
        while True:
            able = np.flatnonzero(unread & (reach >= least - 1e-9))
            if not len(able):
                break
            first = not len(sims)
            if first:
                able = able[np.argsort(-reach[able], kind="stable")[:FIRST_BLOCKS]]
            unread[able] = False
            chosen = np.zeros(self.blocks, bool)
            chosen[able] = True
            if len(able) * 3 < self.blocks:
                some = np.flatnonzero(chosen[block])
                size = self.size[segment[some]]
                at, times = spans(self.start[segment[some]], size), np.repeat(by_segment[some], size)
            else:  # most blocks can: whole lists are read
                a, b = self.begin[terms], self.begin[terms + 1]
                at, times = spans(a, b - a), np.repeat(w, b - a)
            found = part + np.bincount(self.place[at], times * self.held[at], self.room)
            at = np.flatnonzero(found >= max(least - 1e-9, 1e-12))
            at = at[chosen[at // BLOCK]]
            sims, ids = np.concatenate([sims, np.round(found[at], 12)]), np.concatenate([ids, self.order[at]])
            best = np.lexsort((ids, -sims))[:k]
            sims, ids = sims[best], ids[best]
            if len(sims) == k:
                least = float(sims[-1])
            elif not len(sims):
                break
        return list(zip(sims.tolist(), ids.tolist()))


def vote(near: list[tuple[float, int]], labels: np.ndarray, prior: float, pull: float) -> float:
    """Votes weighted by similarity, shrunk towards the share of toxic examples by ``pull`` votes."""
    total = sum(s for s, _ in near)
    return float((sum(s * labels[i] for s, i in near) + pull * prior) / (total + pull))


def pairs(terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.stack([terms, counts], axis=1)


def known_terms(text: str | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Terms of the vocabulary in a text, with their counts."""
    counts = [x for t, n in Counter(terms_of(text)).items() if t in vocabulary for x in (vocabulary[t], n)]
    return np.array(counts, np.int64).reshape(-1, 2)


def fold_votes(sample: Sample, idf: np.ndarray, folds: int, k: int, pull: float):
    """Task function: for each fold of the examples, their votes from the others, which alone weigh the terms."""
    def run(batches):
        for batch in batches:
            for fold in batch.column(0).to_pylist():
                own = np.arange(len(sample.ids)) % folds == fold
                known, asked = sample.only(np.flatnonzero(~own)), sample.only(np.flatnonzero(own))
                if len(known.ids) and len(asked.ids):
                    weight = idf * relevance(known, len(idf))
                    index, prior = BlockMaxIndex([pairs(*v) for v in known.vectors()], weight), float(known.labels.mean())
                    queries = [pairs(*v) for v in asked.vectors()]
                    votes = [vote(near, known.labels, prior, pull) for i in range(0, len(queries), AT_ONCE)
                             for near in index.nearest(queries[i:i + AT_ONCE], weight, k)]
                    yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), pa.array(asked.labels, pa.int32())], names=["vote", "toxic"])
    return run


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibration(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from votes to the share of toxic examples, by Newton's steps; (1, 0) without both labels."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    x, fit = np.stack([logit(votes), np.ones(len(votes))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ fit))
        slope = x.T @ (labels - p) - 1e-3 * (fit - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), slope)
        fit = fit + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return (float(fit[0]), float(fit[1])) if fit[0] > 0 else (1.0, 0.0)


def scores(vocabulary: dict[bytes, int], weight: np.ndarray, sample: Sample, curve: tuple[float, float], k: int, pull: float):
    """Task function: score and evidence of each text. Equal texts are searched once per task."""
    def run(batches):
        index, seen = BlockMaxIndex([pairs(*v) for v in sample.vectors()], weight), {}
        labels = sample.labels
        prior = float(labels.mean()) if len(labels) else 0.0
        for batch in batches:
            texts = batch.column(2).to_pylist()
            keys = [xxhash.xxh3_128_digest((text or "").encode()) for text in texts]
            if len(seen) >= REMEMBERED:
                seen.clear()
            new = {key: text for key, text in zip(keys, texts, strict=True) if key not in seen}
            names = list(new)
            for i in range(0, len(names), AT_ONCE):
                part = names[i:i + AT_ONCE]
                queries = [known_terms(new[key], vocabulary) for key in part]
                for key, near in zip(part, index.nearest(queries, weight, k), strict=True):
                    score = vote(near, labels, prior, pull)
                    if len(labels):
                        score = float(1 / (1 + np.exp(-(curve[0] * logit(score) + curve[1]))))
                    seen[key] = score, [{"id": sample.ids[i], "similarity": s, "toxic": int(labels[i])} for s, i in near[:3]]
            found, evidence = [seen[key][0] for key in keys], [seen[key][1] for key in keys]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array([int(x >= 0.5) for x in found], pa.int32()),
                 pa.array(evidence, pa.list_(pa.struct([("id", pa.string()), ("similarity", pa.float64()), ("toxic", pa.int32())])))],
                names=["id", "held_out", "score", "predicted", "evidence"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             examples: int = 8_192, folds: int = 5, k: int = 15, pull: float = 0.5) -> DataFrame:
    """Toxicity of each document: ``id_col, held_out, score, predicted, evidence``.

    Learns from labelled rows that aren't held out: at most ``examples`` of them, in order of their id's hash (the documented bound
    of the sample, which all that is broadcast or collected follows). All their terms span the vectors: (1 + log tf) times the inverse document
    frequency, counted over all documents, times the square root of the term's chi-squared with the label, which no term has to
    reach. Each document's ``k`` nearest examples by exact cosine vote with their similarity, shrunk towards the share of toxic examples
    by ``pull`` votes; a logistic curve makes the vote a probability. It is fitted to the examples' own votes in ``folds`` folds, where
    neither weights nor neighbours come from a fold itself. ``evidence`` shows the three nearest (ids as text).

    A text without any term of the examples, null and empty texts included, has the vote of the share of toxic examples. Null labels
    and labels of unknown documents teach nothing; of several labels of one id the highest counts, and each of its rows is an example.
    Without labels every score is 0. Ids may be of any type. Rows that repeat an id each get a row; other columns are not looked at.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)))
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).cast("int").alias("toxic"))
    marks = materialised(marks.orderBy(F.xxhash64("id"), "id").limit(examples), "toxicity-labels")
    texts = docs.select(F.col(id_col).alias("id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    known = texts.join(F.broadcast(marks), "id").select(F.col("id").cast("string").alias("id"), "toxic", "text")
    known = known.mapInArrow(example_terms, "id string, toxic int, terms binary, counts binary")
    rows = known.orderBy(F.xxhash64("id", "terms", "counts"), "id").limit(examples).collect()
    named = [bytes(r.terms).split() for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in named for t in terms}))}
    sample = Sample([r.id for r in rows], np.array([r.toxic for r in rows], np.int64), np.cumsum([0, *map(len, named)]),
                    np.array([vocabulary[t] for terms in named for t in terms], np.int64),
                    np.concatenate([np.empty(0, np.int64), *[np.frombuffer(r.counts, "<u4").astype(np.int64) for r in rows]]))

    held = texts.select("text").mapInArrow(document_counts(vocabulary), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counted = dict(zip(held.column("term").to_pylist(), held.column("n").to_pylist(), strict=True))
    total = counted.get(-1, 0)
    idf = np.array([np.log((1 + total) / (1 + counted.get(i, 0))) + 1 for i in range(len(vocabulary))])
    votes = spark.range(0, folds, 1, folds).mapInArrow(fold_votes(sample, idf, folds, k, pull), "vote double, toxic int").collect()
    curve = calibration(np.array([r.vote for r in votes]), np.array([r.toxic for r in votes]))
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(
        scores(vocabulary, idf * relevance(sample, len(idf)), sample, curve, k, pull),
        f"id {kind}, held_out boolean, score double, predicted int, evidence array<struct<id:string,similarity:double,toxic:int>>",
    ).withColumnRenamed("id", id_col)


def op10_toxicity(spark, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
