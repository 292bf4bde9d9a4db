"""Operators on documents against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from firmament.llm import decontamination, exact_dedup, packing, sharding, simhash, substring_dedup

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Benchmark decontamination

def plain_contamination(corpus, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall((t or "").translate(ASCII_LOWER))
    spans = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            spans[tuple(w[i:i + window])].add(item)
    out = []
    for doc_id, text, *_ in corpus:
        w, hit, found = words(text), set(), set()
        for span, ids in spans.items():
            for i in range(len(w) - len(span) + 1):
                if tuple(w[i:i + len(span)]) == span:
                    hit.update(range(i, i + len(span)))
                    found |= ids
        listed = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((doc_id, len(w), len(hit), len([x for x in found if x is not None]), hashlib.sha256(listed.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def items_of(corpus):
    texts = [t for _, t, *_ in sorted(corpus, key=repr) if t and len(t.split()) > 40]
    rng = random.Random(2)
    items = [(i, " ".join(t.split()[5:5 + rng.choice([6, 13, 14, 30])]).upper()) for i, t in enumerate(texts[:12])]
    return items + [(100, "same"), (101, "W1 w2"), (102, None), (103, ""), (104, "not anywhere in the texts at all"), (None, items[1][1]), items[0],
                    (105, items[0][1])]


@pytest.mark.parametrize("block", [200_000, 7])
def test_decontamination(spark, docs, corpus, block):
    items = items_of(corpus)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(docs, table, block=block).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = plain_contamination(corpus, items)
    assert rows(got) == want and any(r[5] for r in want) and any(r[2] and not r[5] for r in want)


def test_decontamination_of_nothing(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not decontamination.decontaminate(docs, none).where("n_hit > 0").count()
    assert decontamination.decontaminate(empty, none).count() == 0


# Substring dedup

def plain_substrings(corpus, width=20):
    texts = [(doc_id, (text or "").encode().split(), (text or "").encode()) for doc_id, text, *_ in corpus]
    key = lambda d, raw: (substring_dedup.NO_ID if d is None else d, xxhash.xxh3_64_intdigest(raw) >> 32)
    first = {}
    for doc_id, words, raw in texts:
        for i in range(len(words) - width + 1):
            at = (*key(doc_id, raw), i)
            span = tuple(words[i:i + width])
            first[span] = min(first.get(span, at), at)
    out = []
    for doc_id, words, raw in texts:
        gone = {j for i in range(len(words) - width + 1) if first[tuple(words[i:i + width])] != (*key(doc_id, raw), i) for j in range(i, i + width)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("part", "chunk", "per_byte"), [(3 << 20, 1 << 22, 0.5), (2000, 1 << 10, 0.5), (500, 1 << 22, 8.0)])
def test_substring_dedup(docs, corpus, monkeypatch, part, chunk, per_byte):
    monkeypatch.setattr(substring_dedup, "PART", part)
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    got = rows(substring_dedup.substring_dedup(docs, counters_per_byte=per_byte))
    want = plain_substrings(corpus)
    assert got == want and sum(r[2] for r in want) > 300
    # Documents with ids that tell all rows apart take the shorter key.
    unique = list({r[0]: r for r in corpus if r[0] is not None}.values())
    table = docs.sparkSession.createDataFrame([r[:2] for r in unique], "doc_id long, text string").repartition(4)
    assert rows(substring_dedup.substring_dedup(table, counters_per_byte=per_byte)) == plain_substrings(unique)


def test_sketch_finds_every_repeat_and_few_others(docs, corpus, monkeypatch):
    """Of the windows of all parts, those that repeat anywhere are estimated repeated, and at full size hardly any other."""
    texts = [(t or "").encode() for _, t, *_ in corpus]
    parts = [pa.table({"part": [i] * len(held), "id": list(range(len(held))), "row": list(range(len(held))), "text": [t.decode() for t in held]})
             for i, held in enumerate([texts[:20], texts[20:50], texts[50:]])]
    windows = [substring_dedup.windows_of(p, 20, substring_dedup.UNIQUE)[3] for p in parts]
    times = Counter(h for w in windows for h in zip(*w.tolist()))
    for counters, most in ((1 << 20, 5), (1 << 8, len(times))):
        chunk = 1 << 6 if counters < 1 << 10 else 1 << 18
        sent = pa.concat_tables([substring_dedup.sketch(20, counters, chunk)(p) for p in parts])
        replies = []
        for row in range(2):
            for number in range(counters // chunk):
                mask = [a == row and b == number for a, b in zip(sent.column("row").to_pylist(), sent.column("chunk").to_pylist())]
                if any(mask):
                    replies += substring_dedup.summed(chunk)(sent.filter(pa.array(mask))).to_pylist()
        wrong = 0
        for i, w in enumerate(windows):
            found = np.ones(w.shape[1], bool)
            for row in range(2):
                found &= substring_dedup.repeated(w[row], counters, chunk, [(r["chunk"], r["repeated"]) for r in replies if r["part"] == i and r["row"] == row])
            really = np.array([times[h] > 1 for h in zip(*w.tolist())])
            assert found[really].all()
            wrong += int((found & ~really).sum())
        assert wrong <= most


def test_texts_are_dealt_once(spark):
    """The three steps that read texts share one exchange of them."""
    table = spark.createDataFrame([(i, f"a b {i} " * 30) for i in range(50)], "doc_id long, text string")
    df = substring_dedup.substring_dedup(table).drop("kept")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 3 and sum("ReusedExchange" in line for line in dealt) == 2


def test_documents_without_own_id_are_told_apart(spark, monkeypatch):
    # The first hash of the text says nothing, as if it collided, and an id has the place of those without.
    monkeypatch.setattr(substring_dedup.xxhash, "xxh3_64_intdigest", lambda data: 7)
    rng = random.Random(6)
    shared = " ".join(f"s{i}" for i in range(30))
    texts = [f"{i} {' '.join(f'u{rng.randrange(10**6)}' for _ in range(i % 9))} {shared}" for i in range(40)]
    ids = [None] * 30 + [4] * 9 + [substring_dedup.NO_ID]
    table = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").coalesce(1)
    key = substring_dedup.MARKED
    given = pa.table({"part": [0] * 40, "id": pa.array(ids, pa.int64()), "row": list(range(40)), "text": texts})
    keys, numbers, _, _ = substring_dedup.windows_of(given, 20, key)
    assert len(np.unique(keys)) == 40 and numbers.tolist() == list(range(40))
    assert rows(substring_dedup.substring_dedup(table).select("doc_id", "n_removed")).count((None, 30)) in (29, 30)


def test_substring_dedup_of_nothing(empty):
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_window_hashes_follow_words():
    texts = [b"a b c a b", b"", b"  x", b"b c a  b\tc"]
    for width in (1, 2, 3, 5):
        sizes, hashes = substring_dedup.window_hashes(texts, width)
        windows = [tuple(w[i:i + width]) for w in map(bytes.split, texts) for i in range(len(w) - width + 1)]
        assert sizes.sum() == len(windows) == hashes.shape[1]
        assert len(set(windows)) == len(set(zip(*hashes.tolist())))
        by = {}
        assert all(by.setdefault(w, h) == h for w, h in zip(windows, zip(*hashes.tolist())))


# Sharding

def test_shards(docs, corpus):
    got = sharding.ring_shards(docs, shards=7, nodes=16).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(corpus) and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(7))
    for s in range(7):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in corpus)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want


@pytest.mark.parametrize(("shards", "nodes"), [(5, 3), (24, 64), (2, 1)])
def test_shards_against_a_walk_of_single_keys(docs, corpus, shards, nodes):
    """Every key goes clockwise by itself, from point to point, until a shard has room; only hashes are shared."""
    spark = docs.sparkSession
    points = sharding.ring(spark, shards, nodes, 7)
    crc = lambda t: zlib.crc32((t or "").encode())
    keys = [(i, len((t or "").encode()) + 8, crc(t)) for i, t, *_ in corpus]
    placed = spark.createDataFrame(keys, "id long, size long, crc long").selectExpr("xxhash64(7, id, crc) AS place", "id", "crc", "size").collect()
    waiting = [[] for _ in points]
    for r in sorted(placed, key=lambda r: (r.place, r.id is not None, r.id or 0, r.crc, r.size)):
        waiting[next((i for i, (end, _) in enumerate(points) if r.place <= end), 0)].append(r)
    room = [len(keys) // shards + (s < len(keys) % shards) for s in range(shards)]
    used, want = [0] * shards, []
    while any(waiting):
        onward = [[] for _ in points]
        for i, (_, shard) in enumerate(points):
            for r in waiting[i]:
                if used[shard] < room[shard]:
                    want.append((r.id, r.size, r.crc, shard, used[shard]))
                    used[shard] += 1
                else:
                    onward[(i + 1) % len(points)].append(r)
        waiting = onward
    got = sharding.ring_shards(docs, shards, nodes).select("doc_id", "size", "text_crc32", "shard", "slot")
    assert rows(got) == sorted(want, key=repr)


def test_shards_move_little(spark):
    many = spark.range(20_000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    before, after = (dict(sharding.ring_shards(many, shards=s).select("doc_id", "shard").collect()) for s in (24, 25))
    moved = sum(before[i] != after[i] for i in before)
    assert moved < 0.5 * len(before)  # dealing by remainder moves 24 of 25


def test_few_and_no_rows(spark, empty):
    few = spark.createDataFrame([(1, "a"), (2, "a"), (None, None)], "doc_id long, text string")
    assert sorted(r.slot for r in sharding.ring_shards(few).collect()) == [0, 0, 0]
    assert sharding.ring_shards(empty).count() == 0


def test_overflow_goes_clockwise():
    placed = sharding.settle([(0, 5), (1, 0), (2, 1)], [2, 2, 2])
    assert placed == [(0, 0, 2, 0, 0), (2, 0, 1, 2, 0), (0, 2, 4, 1, 0), (0, 4, 5, 2, 1)]


# Packing

def plain_best_fit(lengths, window):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(window - n)
    return sorted(room)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_is_that_of_single_pieces(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 64): rng.randrange(1, 9) for _ in range(rng.choice([1, 5, 40]))}
    placed = packing.best_fit(counts, 64)
    used, seen = defaultdict(list), Counter()
    for length, first, end, sequence, offset in placed:
        seen[length] += end - first
        for i in range(end - first):
            used[sequence + i].append((offset, length))
    assert seen == Counter(counts) and sorted(used) == list(range(len(used)))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    want = plain_best_fit([n for n, c in counts.items() for _ in range(c)], 64)
    assert sorted(64 - sum(n for _, n in p) for p in used.values()) == want


def test_packing(docs, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
    got = packing.pack(docs).collect()
    want = Counter()
    for d, t, *_ in corpus:
        own = ids(t)
        want.update((d, s, len(own[s:s + 1024]), zlib.crc32(own[s:s + 1024].tobytes()), len(own)) for s in range(0, len(own), 1024))
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 1024


def test_packing_of_nothing(empty):
    assert packing.pack(empty).count() == 0


def test_ids_are_those_of_the_tokenizers_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    encode = packing.encoder("byte_bpe_50k.tiktoken").encode_ordinary
    for text in ["Don't  stop\n\n 123 ½ ٣٤", "a<|endoftext|>b", "  x\r\n\t", "日本語 עברית 🙂👩‍👩‍👧", "é ß'LL I'll", "\x00\x01 zz", "aaaa" * 300, " " * 50 + "x"]:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_those_of_the_tokenizers_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|><|endoftext|>  \n", "<|endoftext|", "<|<|endoftext|>|> x", "<|ENDOFTEXT|>", "  plain  text "]
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [437, 220, 50256, 1306]
    want = set()
    for i, text in enumerate(texts):
        own = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.add((i, len(own), zlib.crc32(own.tobytes())))
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {(r.doc_id, r.doc_tokens, r.ids_crc32) for r in got.collect()} == want


# Exact dedup

def test_exact_dedup(docs, corpus):
    groups = defaultdict(list)
    for d, t, *_ in corpus:
        groups[(t or "").translate(ASCII_LOWER)].append(d)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(d, keep, len(ids), d == keep, hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    for support in (0.001, 0.04, 0.9):
        assert rows(exact_dedup.exact_dedup(docs, support=support)) == sorted(want, key=repr)


def test_exact_dedup_of_nothing(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0


# SimHash

def plain_groups(corpus, radius=3):
    prints = []
    for d, t, *_ in corpus:
        words = (t or "").translate(ASCII_LOWER).encode().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.append((d, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    known = sorted({f for d, f in prints if d is not None})
    parent = {f: f for _, f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return sorted(((d, f"{f:016x}", least.get(find(f))) for d, f in prints), key=repr)


def test_simhash(docs, corpus):
    assert rows(simhash.simhash_groups(docs)) == plain_groups(corpus)


def test_simhash_of_nothing(empty):
    assert simhash.simhash_groups(empty).count() == 0


@pytest.mark.parametrize("tile", [1024, 16])
def test_near_fingerprints_are_all_connected(spark, tile):
    rng = random.Random(tile)
    codes = {rng.getrandbits(64) for _ in range(150)}
    for centre in list(codes)[:6]:
        for _ in range(60):
            code = centre
            for _ in range(rng.randrange(7)):
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    codes = sorted(codes)
    from firmament.llm.components import components
    table = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c, i) for i, c in enumerate(codes)], "fp long, name long")
    got = dict(components(simhash.near_links(table, tile=tile)).select("node", "component").collect())
    label = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3 and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    assert {i: got.get(i, i) for i in range(len(codes))} == dict(enumerate(label)) and len(set(label)) < len(codes)


def test_gray_index_prunes_nothing_near():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    codes[100:400] = codes[0] ^ (np.uint64(1) << rng.integers(0, 63, 300).astype(np.uint64))
    index = simhash.GrayIndex(codes)
    q, at = index.near(codes[:50], 3)
    got = set(zip(q.tolist(), index.order[at].tolist()))
    want = {(i, j) for i in range(50) for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= 3).tolist()}
    assert got == want and len(index.levels) > 1
