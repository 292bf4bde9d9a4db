"""Collocations, order MinHash and spelling variants against plain versions."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmament.llm import collocations, order_minhash, spelling

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Collocations

def plain_collocations(corpus, support, most=2_000, longest=4):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in corpus:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= support}
        dropped = set()
        for g, above in candidates.items():
            for k in range(2, len(g)):
                dropped.update(g[i:i + k] for i in range(len(g) - k + 1) if 100 * above >= 80 * candidates[g[i:i + k]])
        kept = []
        for g, a in candidates.items():
            if g not in dropped:
                score, _, left, right = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                kept.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:most], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def spoken(corpus):
    """The corpus in several languages with phrases of all strengths, separators of all kinds, words alike in two languages, and a hot phrase."""
    rng = random.Random(9)
    made = []
    for i in range(60):
        words = [rng.choice(["of", "the", "end", "São", "Paulo", "new", "york", "city", "hall", "a b", "x" * 40, "the\x00re", "É"]) for _ in range(rng.choice([0, 1, 5, 80]))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", ".", "\n", "!?", " New York City ", "\r\n", " "]) for w in words)
        made.append((1000 + i, text, rng.choice(["en", "pt", None, "und", ""]), None, 0))
    made.append((2000, "hot phrase here " * 400, "en", None, 0))
    return [(i, t, lang if k % 3 else "pt", s, c) for k, (i, t, lang, s, c) in enumerate(corpus)] + made


@pytest.mark.parametrize("support, most, shards", [(30, 2_000, 10), (3, 2_000, 10), (2, 5, 1), (7, 2_000, 3)])
def test_collocations(spark, spoken, support, most, shards):
    docs = spark.createDataFrame(spoken, "doc_id long, text string, lang string, id string, n long").repartition(7)
    got = rows(collocations.collocations(docs, support=support, most=most, shards=shards))
    assert got == plain_collocations(spoken, support, most)
    assert got


def test_collocations_of_many_chunks(spark, spoken, monkeypatch):
    docs = spark.createDataFrame(spoken, "doc_id long, text string, lang string, id string, n long").repartition(3)
    slots = collocations.frequent_phrases(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"), 2, 5, 4)[0][1]
    want = {g for g in plain_collocations(spoken, 5, 10**6, longest=2)}
    assert slots.count() == len(want)


def test_chunk_is_held_in_little_memory():
    """A chunk's words are numbered text by text: as objects all at once they took many times the bytes of the texts."""
    texts = [f"{'one two six ten ' * 250}{i}.".encode() for i in range(500)]
    tracemalloc.start()
    state = collocations.chunk_of(0, "en", texts, 1, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert state.column("n")[0].as_py() == 500 * 1001
    assert peak < 10 * sum(map(len, texts))


def test_collocations_of_nothing(spark, empty):
    assert rows(collocations.collocations(empty)) == []
    odd = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "one two", "en"), (4, ". , ;", "en")], "doc_id long, text string, lang string")
    assert rows(collocations.collocations(odd)) == []


# Order MinHash

def plain_fingerprint(text, width=order_minhash.WIDTH, length=order_minhash.LENGTH, bins=order_minhash.BINS):
    """Counts occurrences and takes the smallest ranks one k-mer at a time; only the hash functions are shared."""
    if not text:
        return np.zeros(bins, np.uint16)
    width = min(width, len(text))
    seen, ranked = Counter(), defaultdict(list)
    hashes = order_minhash.kmers(order_minhash.code_points(text), width)
    for i in range(len(text) - width + 1):
        kmer = text[i:i + width]
        rank = int(order_minhash.mixed(hashes[i:i + 1] + np.uint64(seen[kmer]) * order_minhash._NUMBER)[0])
        seen[kmer] += 1
        ranked[rank >> 58].append((rank, i))
    out = np.zeros(bins, np.uint16)
    for b, held in ranked.items():
        found = np.zeros(1, np.uint64)
        for j, i in enumerate(sorted(i for _, i in sorted(held)[:length])):
            found = order_minhash.mixed(found * order_minhash._FACTOR + hashes[i:i + 1] + np.uint64(j + 1))
        out[b] = int(found[0]) % 65535 + 1
    return out


@pytest.mark.parametrize("text", ["", "a", "ab" * 30, "x" * 5000, "the cat sat on the mat. " * 9, "é𝄞ü" * 50, "".join(random.Random(1).choices("abcdefg ", k=9000))])
def test_fingerprint(text):
    assert order_minhash.fingerprint(text).tolist() == plain_fingerprint(text).tolist()


def test_occurrences_of_long_texts_agree():
    hashes = order_minhash.kmers(order_minhash.code_points("abcabcabd" * 500))
    seen, want = Counter(), []
    for h in hashes.tolist():
        want.append(seen[h])
        seen[h] += 1
    assert order_minhash.occurrences(hashes).tolist() == want


def test_order_counts():
    rng = random.Random(3)
    half = ["".join(rng.choices("abcdefghij ", k=4000)) for _ in range(2)]
    same, turned = order_minhash.fingerprint(half[0] + half[1]), order_minhash.fingerprint(half[1] + half[0])
    assert order_minhash.likeness(same, same) == 1.0
    assert 0.3 < order_minhash.likeness(same, turned) < 0.75  # tuples within a half stay, those across it turn round
    assert order_minhash.likeness(same, order_minhash.fingerprint("".join(rng.choices("abcdefghij ", k=8000)))) < 0.05


def plain_order(corpus):
    ordered = sorted(((i is None, i or 0, t or "") for i, t, *_ in corpus))
    return ordered


def test_order_minhash(spark, docs, corpus):
    """With ids that tell all rows apart, every value against a plain walk through the sorted documents."""
    unique = {}
    for i, t, *_ in corpus:
        unique.setdefault(i, t)
    ordered = sorted(unique.items(), key=lambda x: (x[0] is None, x[0] or 0))
    want = []
    for (i, t), (_, u) in zip(ordered, [*ordered[1:], ordered[0]]):
        t, u = t or "", u or ""
        cut = len(t) // 4
        new = t[:len(t) - cut] + u[:cut]
        a, b, c = plain_fingerprint(t), plain_fingerprint(new), plain_fingerprint(u)
        like = lambda x, y: 1.0 if not (x.any() or y.any()) else ((x == y) & (x != 0)).sum() / ((x != 0) | (y != 0)).sum()
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), a.astype(">u2").tobytes().hex(), b.astype(">u2").tobytes().hex(),
                     float(like(a, b)), float(like(a, c))))
    table = spark.createDataFrame([(i, t, "x", 0) for i, t in unique.items()], "doc_id long, text string, id string, task int").repartition(6)
    assert rows(order_minhash.order_minhash(table)) == sorted(want, key=repr)


def test_order_minhash_odd_rows(spark, docs, corpus, empty):
    assert rows(order_minhash.order_minhash(empty)) == []
    got = rows(order_minhash.order_minhash(docs))
    assert sorted((r[0], r[1]) for r in got if r[0] is not None) == sorted((i, len(t or "")) for i, t, *_ in corpus if i is not None)
    assert len(got) == len(corpus)
    marks = defaultdict(set)
    for i, t, *_ in corpus:
        marks[t or ""].add(i)
    by_id = {r[0]: r[3] for r in got if [x[0] for x in corpus].count(r[0]) == 1}
    for ids in marks.values():
        assert len({by_id[i] for i in ids if i in by_id}) <= 1
    one = spark.createDataFrame([(None, "only one text of some length here")], "doc_id long, text string")
    (row,) = order_minhash.order_minhash(one).collect()
    assert row.near_next == 1.0 and row.n_chars == 33
    hot = spark.createDataFrame([(7, "same text " * 5)] * 40 + [(None, None)] * 40, "doc_id long, text string").repartition(8)
    assert len(rows(order_minhash.order_minhash(hot))) == 80


# Spelling variants

def plain_spelling(corpus, every, least_n=3, least_length=5):
    counts = Counter()
    for doc_id, text, *_ in corpus:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_n}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out, forms = {}, {}
    for w, n in words.items():
        close = [v for v in words if v != w and near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = len(close)
    result = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        result.append((w, forms[w], root, n, out[w], words[forms[w]] if forms[w] else None))
    return sorted(result, key=repr)


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(11)
    base = ["aaaaa", "aaaaaa", "aaaaaaa", "hello", "hallo", "hullo", "jello", "hell", "receive", "recieve", "déjàvu", "dejàvu", "ÀÉÎõü", "àéîõü", "x" * 60, "×÷×÷×"]
    for _ in range(120):
        word = list(rng.choice(base[3:]))
        at = rng.randrange(len(word))
        word[at:at + 1] = rng.choice([[], [rng.choice("abé")], [word[at], rng.choice("abé")], [word[at], word[at]]])
        base.append("".join(word))
    weighted = [w for i, w in enumerate(base) for _ in range(rng.choice([1, 2, 4, 9, 40]))]
    docs = []
    for i in range(300):
        text = " ".join(rng.choice([w, w.upper(), w + "'s", "1" + w + "_", w + "!"]) for w in rng.choices(weighted, k=rng.choice([0, 3, 30])))
        docs.append((rng.choice([i, i, None, 5]), text))
    return docs + [(1, None), (None, None), (2, ""), (3, "deriver " * 2000), (3, "deriver " * 2000)]


@pytest.mark.parametrize("every", [0, 97, 3])
def test_spelling(spark, misspelt, every):
    docs = spark.createDataFrame(misspelt, "doc_id long, text string").repartition(5).withColumns({"id": F.lit("x"), "word": F.lit(1), "n": F.lit(2), "key": F.lit(3)})
    got = rows(spelling.spelling_variants(docs, every=every))
    assert got == plain_spelling(misspelt, every)
    assert sum(r[2] != r[0] for r in got) > 5


def test_spelling_chains(spark):
    words = {"aaaaabbbbb"[i:i + 5]: 3 * 2**i for i in range(6)}
    words |= {"c" * 5 + "d" * i: 3 * 2**i for i in range(9)}
    docs = spark.createDataFrame([(1, " ".join(w for w, n in words.items() for _ in range(n)))], "doc_id long, text string")
    assert rows(spelling.spelling_variants(docs)) == plain_spelling([(1, r.text) for r in docs.collect()], 0)


def test_spelling_of_nothing(spark, empty):
    assert rows(spelling.spelling_variants(empty)) == []
    assert rows(spelling.spelling_variants(spark.createDataFrame([(1, "word"), (2, None)], "doc_id long, text string"))) == []


def test_ranges_across_batches():
    """Ranges of sorted rotations that Arrow batches cut."""
    import pyarrow as pa

    words = {"abcde": 5, "abcdf": 9, "abcdg": 2, "abcd": 7, "abbde": 4}
    turned = list(spelling.rotations([pa.RecordBatch.from_arrays([pa.array(words), pa.array(words.values())], names=["word", "n"])]))
    table = pa.Table.from_batches(turned).sort_by("key")
    results = []
    for size in (1, 2, 3, 100):
        found = list(spelling.scanned(table.to_batches(max_chunksize=size)))
        results.append(sorted(pa.Table.from_batches(found).to_pylist(), key=repr))
    assert all(r == results[0] for r in results) and results[0]
