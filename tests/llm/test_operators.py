"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and at its edges."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spanloom.llm import language, licence, mixing, neighbours, ngram_lm, packing, passages, quality, shared, simhash, syncmers, texts
from spanloom.llm.shared import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size string, mark string, target string, taken string"


def sentence(rng, n):
    return " ".join("".join(rng.choice(["ta", "ri", "so", "un", "el", "mo", "ké"]) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, nulls, empty and very long texts, a hot source, ties, and extra columns with clashing names."""
    rng = random.Random(4)
    base = ["\n".join(sentence(rng, rng.randint(4, 14)) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    shared = " ".join(sentence(rng, 9) for _ in range(9))
    all_texts = base + base[:10] + [base[0]] * 30
    all_texts += [re.sub(r"ta\b", "zz", b, count=1) for b in base[10:20]]
    all_texts += [f"{sentence(rng, 7)[:-1]} {shared} {sentence(rng, 8)}" for _ in range(6)]
    all_texts += [None, "", "   \n", "one", "One two", "123 456", "x" * 5000, " ".join(["word"] * 3000), sentence(rng, 20000), "a　b \x1c c d  e", "it's  <|endoftext|>\r\n\tend "]
    out = [(i, t, rng.choice(["en", "xx", None]), None if i % 17 == 0 else "hot" if i % 3 == 0 else f"s{i % 4}", len(t or ""), "size", "mark", "target", "taken") for i, t in enumerate(all_texts)]
    return [*out, out[5], out[5]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({x for p in links for x in p}, links)
    assert found == {x: want[x] for x in {y for a, b in links if a != b for y in (a, b)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_bounds_and_shingles(rows):
    import pyarrow as pa

    some = [r[1] for r in rows]
    data, offsets = texts.flat(pa.array(some, pa.string()))
    starts, ends, firsts = texts.word_bounds(data, offsets)
    raw = data.tobytes()
    assert [[raw[a:b].decode() for a, b in zip(starts[x:y], ends[x:y], strict=True)] for x, y in zip(firsts[:-1], firsts[1:], strict=True)] == [WORD.findall(t or "") for t in some]
    hashes = texts.word_hashes(data, starts, ends)
    by = collections.defaultdict(set)
    for h, a, b in zip(hashes, starts, ends, strict=True):
        by[raw[a:b]].add(int(h))
    assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)
    _, to = texts.shingles(hashes, firsts, 5)
    assert np.diff(to).tolist() == [0 if not (n := len(WORD.findall(t or ""))) else max(1, n - 4) for t in some]


def test_simhash_groups(docs, rows, empty):
    prints = {}
    for i, t, *_ in rows:
        w = words_of(t)
        h = [xxhash.xxh64_intdigest(" ".join(w[j : j + 3]), 42) for j in range(max(1, len(w) - 2))] if w else []
        prints[i] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    ids = sorted(prints)
    want = roots(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 2])
    found = simhash.hamming_groups(docs, 3, 2).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(i, f"{prints[i]:016x}", want[i]) for i in ids}
    assert simhash.hamming_groups(empty, 3, 2).count() == 0


def test_near_copies(docs, rows, empty):
    kept = simhash.one_of_each(docs).collect()
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := words_of(t)) else set() for i, t, *_ in rows}
    near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    ids = {r.doc_id for r in kept}
    assert len(kept) == len(ids) and set(kept[0].asDict()) == set(docs.columns)
    by_text = collections.defaultdict(list)
    for i, t, *_ in rows:
        by_text[t].append(i)
    assert all(len(ids & set(v)) <= 1 for t, v in by_text.items())
    for i, s in sets.items():
        if i not in ids:  # what goes has something like it
            assert max(near(s, t) for k, t in sets.items() if k != i) >= 0.8
    unlike = [(a, b) for a in sets for b in sets if a < b and near(sets[a], sets[b]) >= 0.8]
    assert sum(a in ids and b in ids for a, b in unlike) <= 0.01 * len(unlike)
    assert simhash.one_of_each(empty).count() == 0


def test_ring_budgets(spark):
    rng = random.Random(2)
    pairs = [(a := rng.getrandbits(63), a ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 12)))) for _ in range(300)]
    cut = lambda x: [(x >> s) & 0xFFFF for s in (0, 16, 32, 48)]

    def brute(a, b, tau):
        d = [(x ^ y).bit_count() for x, y in zip(cut(a), cut(b), strict=True)]
        return any(all(sum(d[(i + j) % 4] for j in range(n)) <= tau * n // 4 for n in range(1, 5)) for i in range(4))

    df = spark.createDataFrame(pairs, "a long, b long")
    seg = lambda c: [F.shiftrightunsigned(c, s).bitwiseAND(F.lit(0xFFFF)) for s in (0, 16, 32, 48)]
    found = df.select(simhash.on_ring(seg("a"), seg("b"), 8)).collect()
    assert [r[0] for r in found] == [brute(a, b, 8) for a, b in pairs]
    assert all(brute(a, b, 8) for a, b in pairs if (a ^ b).bit_count() <= 8)  # the filter loses nothing


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_ring_prunes_candidates(spark):
    """All pairs within two bits meet; of those that meet, the ring leaves out what is over its budgets."""
    rng = random.Random(3)
    prints = []
    for _ in range(40):
        x = rng.getrandbits(64)
        prints += [x, *(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 2))) for _ in range(3))]
        prints += [(x & (1 << 43) - 1) | rng.getrandbits(21) << 43 for _ in range(3)]  # meet in two segments, far in the third
    by = collections.defaultdict(set)
    for r in simhash.candidates(spark.createDataFrame([(signed(x),) for x in set(prints)], "node long"), 2).collect():
        by[r.key].add(r.node % 2**64)
    met = {(a, b) for v in by.values() for a in v for b in v if a < b}
    near = {(a, b) for a in set(prints) for b in set(prints) if a < b and (a ^ b).bit_count() <= 2}
    assert len(near) > 60 and near <= met
    left = simhash.within_ring(spark.createDataFrame([(signed(a), signed(b)) for a, b in met], "a long, b long"), 2)
    left = {tuple(sorted((r.a % 2**64, r.b % 2**64))) for r in left.collect()}
    assert near <= left and len(left) <= len(met) - 100


def test_buckets(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(400), rng.randrange(30)) for _ in range(900)] + [(1000, i) for i in range(500)] * 2 + [(1001, 7)] * 300
    want = collections.defaultdict(set)
    for k, n in rows:
        want[k].add(n)
    found = shared.buckets(spark.createDataFrame(rows, "key long, node long").repartition(5)).collect()
    assert sorted(map(tuple, found)) == sorted((k, n, min(v)) for k, v in want.items() if len(v) > 1 for n in v)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_runs_across_batches(size):
    import pyarrow as pa

    rng = random.Random(size)
    rows = sorted((rng.randrange(12), rng.randrange(6)) for _ in range(60))
    batches = [pa.record_batch({"key": [r[0] for r in rows[i : i + size]], "node": [r[1] for r in rows[i : i + size]]}) for i in range(0, len(rows), size)]
    found = [r for b in shared._run_batches(iter(batches)) for r in zip(*b.to_pydict().values(), strict=True)]
    want = collections.defaultdict(set)
    for k, n in rows:
        want[k].add(n)
    assert sorted(found) == sorted((k, n, min(v)) for k, v in want.items() if len(v) > 1 for n in v)


def test_compared_blocks(spark, monkeypatch):
    """Every pair of a bucket that lies across components is compared, whatever the blocks."""
    monkeypatch.setattr(shared, "BLOCK", 4)
    rng = random.Random(8)
    rows = [(k, n) for k in range(6) for n in rng.sample(range(60), 30)]
    links = [(a, b) for a, b in ((rng.randrange(60), rng.randrange(60)) for _ in range(25)) if a != b]
    value = {n: [rng.randrange(12)] for n in range(60)}
    near = lambda left, right: np.array([[x[0] == y[0] for y in right] for x in left])
    base = spark.createDataFrame(links, "a long, b long")
    found = shared.bucket_links(spark.createDataFrame(rows, "key long, node long"), base, spark.createDataFrame(list(value.items()), "node long, v array<long>"), near)
    every = links + [(a, b) for k in range(6) for a in [n for j, n in rows if j == k] for b in [n for j, n in rows if j == k] if value[a] == value[b]]
    assert roots(range(60), [tuple(r) for r in found.collect()]) == roots(range(60), every)


def split_print(print_):
    return [print_[i : i + 8] for i in range(0, len(print_), 8)]


def plain_likeness(a, b):
    """Likeness of two fingerprints from their strings alone."""
    cut = min(max(x) if len(x) >= syncmers.SKETCH else "g" for x in (a, b))
    p, q = ([h for h in x if h <= cut] for x in (a, b))
    at = [q.index(h) for h in p if h in q]
    run = [1] * len(at)
    for i in range(len(at)):
        run[i] = 1 + max((run[j] for j in range(i) if at[j] < at[i]), default=0)
    every = len(p) + len(q) - len(at)
    return max(run, default=0) / every if every else 1.0


def test_likeness_is_symmetric_and_in_order(spark):
    rng = random.Random(6)
    pairs = [([5, 6, 1, 2], [1, 2, 5, 6]), ([2, 4, 1, 3], [1, 2, 3, 4]), ([], []), ([], [1]), ([7], [7])]
    for _ in range(60):
        some = rng.sample(range(40), 14)
        pairs.append((some[:10], rng.sample(some, 11)))
    whole = rng.sample(range(10**6), syncmers.SKETCH)
    pairs.append((whole, sorted(whole)))
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    found = df.select("a", "b", syncmers.likeness(F.col("a"), F.col("b")).alias("x"), syncmers.likeness(F.col("b"), F.col("a")).alias("y")).collect()
    digits = lambda x: [f"{h:08x}" for h in x]
    assert all(r.x == r.y and math.isclose(r.x, plain_likeness(digits(r.a), digits(r.b))) for r in found)
    assert [r.x for r in found[:5]] == [0.5, 0.5, 1.0, 0.0, 1.0]


def test_syncmers(docs, rows, empty):
    found = sorted(map(tuple, syncmers.fingerprinted(docs).collect()))
    assert len(found) == len(rows)
    unique = sorted({r[0]: r[1] or "" for r in rows}.items())
    by, prints = {}, collections.defaultdict(set)
    for k, (i, t) in enumerate(unique):
        by[i] = (t, unique[(k + 1) % len(unique)][1])
    for r in found:
        prints[by[r[0]][0]].add(r[3])
        prints[by[r[0]][0]].discard(None)
    assert all(len(v) == 1 for v in prints.values())  # equal texts, equal fingerprints
    one = {t: next(iter(v)) for t, v in prints.items()}
    for r in found:
        t, after = by[r[0]]
        if r[0] != 5:  # that id is there three times, so two of it are followed by a copy
            edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
            assert r[1:3] == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert one.get(edited, r[4]) == r[4]
            assert math.isclose(r[6], plain_likeness(split_print(r[3]), split_print(one[after])))
        assert math.isclose(r[5], plain_likeness(split_print(r[3]), split_print(r[4])))
        assert len(r[3]) % 8 == 0 and len(r[3]) <= 8 * syncmers.SKETCH
    assert max(len(r[3]) for r in found) == 8 * syncmers.SKETCH
    assert syncmers.fingerprinted(empty).count() == 0


def test_syncmers_in_order(spark):
    """The same anchors in another order are less alike; a shared first half counts for its share."""
    rng = random.Random(10)
    parts = [[f"w{rng.randrange(9000)}" for _ in range(6)] for _ in range(40)]
    join = lambda p: " ".join(w for x in p for w in x)
    mixed_up = rng.sample(parts, len(parts))
    df = spark.createDataFrame([(join(parts), join(mixed_up), join(parts[:20] + [[f"v{i}{j}" for j in range(6)] for i in range(20)]))], "a string, b string, c string")
    s = {c: syncmers.sketch(syncmers.anchors(F.col(c))) for c in "abc"}
    r = df.select(syncmers.likeness(s["a"], s["a"]).alias("same"), syncmers.likeness(s["a"], s["b"]).alias("mixed"), syncmers.likeness(s["a"], s["c"]).alias("half")).first()
    assert r.same == 1.0 and r.mixed < 0.3 and 0.25 < r.half < 0.42


def test_syncmers_are_context_free(spark):
    rng = random.Random(9)
    inner = [f"w{rng.randrange(500)}" for _ in range(60)]
    whole = " ".join([f"a{rng.randrange(99)}" for _ in range(17)] + inner + [f"b{rng.randrange(99)}" for _ in range(23)])
    df = spark.createDataFrame([(" ".join(inner), whole)], "x string, y string").select(*[syncmers.anchors(F.col(c)).alias(c) for c in "xy"]).first()
    assert {(a["place"] + 17, a["hash"]) for a in df.x} <= {(a["place"], a["hash"]) for a in df.y}
    h = [xxhash.xxh64_intdigest(w, 42) for w in inner]
    pair = spark.createDataFrame([(i, *[x - 2**64 if x >= 2**63 else x for x in h[i : i + 2]]) for i in range(59)], "i int, a long, b long").select("i", F.xxhash64("a", "b").alias("g")).orderBy("i").collect()
    g = [r.g for r in pair]
    assert [a["place"] for a in df.x] == [i for i in range(56) if min(g[i], g[i + 3]) <= min(g[i + 1 : i + 3])]


def test_language_model(docs, rows, empty):
    found = {r.doc_id: r for r in ngram_lm.scored(docs).collect()}
    train = [words_of(t) + [None] for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = [collections.Counter(x for w in train for x in zip(*[w[j:] for j in range(n)], strict=False)) for n in (1, 2, 3)]
    total, distinct = sum(c[0].values()), len(c[0])
    once, twice = (sum(1 for v in c[0].values() if v == k) for k in (1, 2))
    first = once / (once + 2 * twice)
    unknown = max(first * distinct / total, 1 / (total + distinct + 1))
    taken = [collections.Counter(), collections.Counter(), collections.Counter()]
    for n in (1, 2):
        for k, v in c[n].items():
            taken[n][k[:-1]] += v - 0.75

    def p(gram):
        if len(gram) == 1:
            return max(c[0][gram] - first, 1e-9) / total if gram in c[0] else unknown
        context, n = gram[:-1], len(gram) - 1
        if context not in taken[n]:
            return p(gram[1:])
        rest = max(1 - taken[n][context] / c[n - 1][context], 1e-9) * p(gram[1:])
        return (c[n][gram] - 0.75) / c[n - 1][context] + rest if gram in c[n] else rest

    for i, t, *_ in rows:
        w, r = [*words_of(t), None], found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum((x,) in c[0] for x in w), total, zlib.crc32(str(i).encode()) % 7 == 2)
        assert math.isclose(r.base_score, sum(math.log10((c[0][(x,)] + 1) / (total + distinct + 1)) for x in w), abs_tol=1e-6)
        assert math.isclose(r.score, sum(math.log10(p(tuple(w[max(0, k - 2) : k + 1]))) for k in range(len(w))), abs_tol=0.01 * len(w))
    by = collections.defaultdict(set)
    for i, t, *_ in rows:
        by[" ".join(words_of(t))].add((found[i].base_score, found[i].score))
    assert all(len(v) == 1 for v in by.values())  # equal sequences score equally wherever they stand
    assert ngram_lm.scored(empty).count() == 0


def test_merged_shards(monkeypatch):
    """Blocks of a shard are merged while they arrive, also where many hold one code."""
    import pyarrow as pa

    monkeypatch.setattr(ngram_lm, "MERGE", 50)
    rng = np.random.default_rng(1)
    want = collections.defaultdict(collections.Counter)
    rows = []
    for _ in range(60):
        shard = int(rng.integers(0, 3))
        code = np.unique(rng.integers(0, 80, 30))
        n = rng.integers(1, 5, len(code))
        want[shard].update(dict(zip(code.tolist(), n.tolist(), strict=True)))
        rows.append((shard, ngram_lm._packed(code.astype(np.int64)), ngram_lm._planes(n.astype(np.uint32)), ngram_lm._planes((code + 1).astype(np.uint16))))
    rows.sort(key=lambda r: r[0])
    batches = [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*part, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)], names=["shard", "codes", "counts", "below"]) for part in (rows[:25], rows[25:26], rows[26:])]
    got = list(ngram_lm._merged(iter(batches)))
    assert {shard: dict(zip(code.tolist(), n.tolist(), strict=True)) for shard, code, n, _ in got} == {k: dict(v) for k, v in want.items()}
    assert all((below == code + 1).all() for _, code, _, below in got)
    for code in (np.array([5]), np.array([7, 2**62 + 2**61]), np.unique(rng.integers(0, 2**60, 900))):
        assert (ngram_lm._unpacked(ngram_lm._packed(code), len(code)) == code).all()


def test_elias_fano():
    rng = np.random.default_rng(3)
    for values in (np.zeros(0, np.uint64), np.array([0], np.uint64), np.sort(rng.integers(0, 90, 400)).astype(np.uint64), np.unique(rng.integers(0, 2**64 - 1, 5000, dtype=np.uint64))):
        ef = ngram_lm.EliasFano(ngram_lm.EliasFano.build(values))
        at = np.arange(len(values))
        assert (ef.at(at) == values).all() if len(values) else ef.n == 0
        if len(values) > 1:
            assert all((x == y).all() for x, y in zip(ef.at_and_after(at[:-1]), (values[:-1], values[1:]), strict=True))
        ask = np.concatenate([values, values + np.uint64(1), rng.integers(0, 2**64 - 1, 50, dtype=np.uint64), np.zeros(1, np.uint64)])
        at, exact = ef.find(ask)
        assert (at == np.searchsorted(values, ask)).all() and (exact == np.isin(ask, values)).all()


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.default_tokenizer())
    coder.encode_special_tokens = True
    ids = {i: np.array([*coder.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t, *_ in rows}
    found = packing.packed(docs, packing.default_tokenizer(), capacity=256).toPandas()
    for r in found.itertuples():
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert found.length.sum() == sum(len(ids[r[0]]) for r in rows)
    for _, s in found.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 256
    assert packing.packed(empty, packing.default_tokenizer()).count() == 0


def test_packing_plan():
    rng = random.Random(8)
    counts = {n: rng.randint(1, 400) for n in rng.sample(range(1, 1025), 500)}
    used, seen = collections.Counter(), collections.Counter()
    for length, _, number, first, offset in packing.plan(counts):
        seen[length] += number
        for s in range(first, first + number):
            assert used[s] == offset
            used[s] += length
    assert seen == counts and max(used.values()) <= 1024
    assert sum(1024 - u for u in used.values()) < 0.05 * sum(used.values())


def test_mixing(docs, rows, empty):
    found = mixing.mixed(docs, ["doc_id", "source"]).toPandas()
    size = collections.Counter()
    for _, t, _, s, *_ in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = {}, 1.5 * sum(size.values())
    while True:
        rest, share = total - sum(full.values()), sum(weight[s] for s in names if s not in full)
        level = {s: rest * weight[s] / share for s in names if s not in full}
        if not (over := [s for s in level if level[s] > 2 * size[s]]):
            break
        full |= {s: 2 * size[s] for s in over}
    want = level | full
    assert len(found) == len(rows) and (found.taken <= 2 * found["size"]).all()
    for s in names:
        own = found[found.source.isna()] if s is None else found[found.source == s]
        assert abs(own.target.iloc[0] - want[s]) < 1e-6 and own.source_size.iloc[0] == size[s]
        assert abs(own.taken.sum() - want[s]) <= 4 * mixing.BLOCK
    again = mixing.mixed(docs.repartition(5), ["doc_id"]).toPandas()
    assert sorted(zip(again.doc_id, again.taken, strict=True)) == sorted(zip(found.doc_id, found.taken, strict=True))
    assert mixing.mixed(empty, ["doc_id"]).count() == 0
    times = collections.Counter(r.doc_id for r in mixing.repeated(docs).collect())
    assert all(times[i] <= 2 * (3 if i == 5 else 1) for i in times)


def test_schedule_is_even(spark):
    goals = spark.createDataFrame([("a", 10, 5, 6000.0), ("b", 10, 2, 3000.0), ("c", 10, 1, 1000.0)], "source string, source_size long, weight int, target double")
    slots = [r.source for r in mixing.schedule(goals, 1).orderBy("slot").collect()]
    assert len(slots) == 10000
    for at in range(0, 10000, 500):
        part = collections.Counter(slots[at : at + 500])
        assert abs(part["a"] - 300) <= 4 and abs(part["b"] - 150) <= 4 and abs(part["c"] - 50) <= 4
    ranks = mixing.ranked(mixing.schedule(goals, 1), 10000).orderBy("slot").collect()
    seen = collections.Counter()
    for r in ranks:
        assert r.block == seen[r["__name"]]
        seen[r["__name"]] += 1


def golden(t):
    from decimal import Decimal, getcontext

    getcontext().prec = 40
    phi = (Decimal(5).sqrt() - 1) / 2
    return float((t + Decimal(1) / 2) * phi % 1)


def test_mixing_takes_scheduled_blocks(docs, rows):
    """Words taken, document by document, from a plain walk over slots, ranks and blocks."""
    found = mixing.mixed(docs.where("doc_id <> 5"), ["doc_id", "source"]).toPandas().sort_values("place")
    goals = found[["source", "target", "source_size"]].drop_duplicates()
    names = [*sorted(s for s in goals.source if s is not None), *([None] if goals.source.isna().any() else [])]
    target = {None if s is None or s != s else s: t for s, t in zip(goals.source, goals.target, strict=True)}
    total, low, bounds = sum(target.values()), 0.0, []
    for s in names:
        bounds.append((low, low + target[s], s))
        low += target[s]
    ranks = collections.Counter()
    for t in range(int(-(-total // mixing.BLOCK))):
        x = golden(t) * total
        ranks[next(s for lo, hi, s in bounds if lo <= x < hi)] += 1
    for s in names:
        own = found[found.source.isna()] if s is None else found[found.source == s]
        words = [i for i, n in zip(own.doc_id, own["size"], strict=True) for _ in range(n)] * 2
        want = collections.Counter(words[: ranks[s] * mixing.BLOCK])
        assert {i: n for i, n in zip(own.doc_id, own.taken, strict=True) if n} == dict(want)
    assert found.slot[found.taken > 0].notna().all() and found.slot[found.taken == 0].isna().all()


def test_passages(docs, rows, empty):
    found = passages.repeated(docs).collect()
    sharers = [r[0] for r in rows if r[1] and "\n" not in r[1] and 80 < len(words_of(r[1])) < 110]
    assert len(sharers) == 6 and set(sharers) <= {r.doc_id for r in found}
    assert {r.doc_id for r in found if r.removed} >= set(sharers[1:]) and sharers[0] not in {r.doc_id for r in found if r.removed}
    text = {r[0]: r[1] for r in rows}
    for r in found:
        words = WORD.findall(text[r.doc_id])[r.first_word : r.first_word + r.words]
        assert len(words) == r.words and WORD.findall(text[r.doc_id].encode()[r.begin : r.close].decode()) == words
    kept = {r.doc_id: r for r in passages.without_repeats(docs).collect()}
    alone = [i for i, t in text.items() if 20 <= i < 60]
    assert all(kept[i].text == text[i] for i in alone)
    assert kept[sharers[0]].text == text[sharers[0]]
    # what is left of the others are the seven words before the shared ones and the eight behind
    assert all(WORD.findall(kept[i].text) == WORD.findall(text[i])[:7] + WORD.findall(text[i])[-8:] and kept[i].n_chars == len(kept[i].text) for i in sharers[1:])
    copies = {i for i, t in text.items() if t == text[0]}
    assert len(copies) > 20 and all(i not in kept for i in copies - {min(copies)}) and kept[min(copies)].text == text[0]
    assert passages.repeated(empty).count() == 0 and passages.without_repeats(empty).count() == 0


@pytest.mark.parametrize("ends", [10, 25, 0])
def test_passages_of_fifty_words(spark, ends):
    """Passages of 51 to 60 words in foreign surroundings, with sentences of some length or none, against a plain search."""
    rng = random.Random(ends)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    body = lambda n: [word() + ("." if ends and rng.random() < 1 / ends else "") for _ in range(n)]
    all_texts, planted = [], []
    for _ in range(150):
        shared = body(rng.randint(51, 60))
        for _ in range(2):
            planted.append((len(all_texts), " ".join(shared)))
            all_texts.append(" ".join([*body(rng.randint(20, 90)), *shared, *body(rng.randint(20, 90))]))
    short = body(20)
    all_texts += [" ".join([*body(40), *short, *body(40)]) for _ in range(20)]  # repeats that are no passage
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(all_texts)], "doc_id long, text string, n_chars long").repartition(4)
    kept = {r.doc_id: r.text for r in passages.without_repeats(df).collect()}
    caught = [i for i, shared in planted if i % 2 and shared not in kept[i]]
    assert len(caught) >= (0.97 if ends else 0.9) * 150
    clean = sum(WORD.findall(kept[i]) == [w for w in WORD.findall(all_texts[i]) if w not in set(shared.split())] for i, shared in planted if i % 2)
    assert clean >= 0.9 * len(caught)  # a paragraph at an end that is alike as a whole takes a foreign word or two along
    assert all(kept[i] == t for i, t in enumerate(all_texts) if i >= 300 or i % 2 == 0)


def test_paragraph_cuts_do_not_depend_on_context():
    import pyarrow as pa

    rng = random.Random(6)
    inner = " ".join(sentence(rng, 8) for _ in range(12))
    cut = lambda t: {(int(h)) for h in passages.Paragraphs(*texts.flat(pa.array([t]))).hash}
    assert len(cut(inner) & cut(f"{sentence(rng, 5)[:-1]} {inner} {sentence(rng, 9)}")) >= len(cut(inner)) - 3


def test_passages_in_mixed_buckets(spark):
    """Pairs alike at 0.8 that meet in bands with many unlike paragraphs."""
    import pyarrow as pa

    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    common = [word() for _ in range(400)]
    all_texts = [" ".join(w if rng.random() > 0.04 else word() for w in common) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(all_texts)), "doc_id long, text string")
    sets, keys = {}, collections.defaultdict(set)
    for t in all_texts:
        found, words = passages.Paragraphs(*texts.flat(pa.array([t]))), t.split()
        for h, a, b in zip(found.hash.view(np.int64).tolist(), found.first, found.end, strict=True):
            if b - a >= passages.LEAST_WORDS:
                sets[h] = {tuple(words[k : k + 5]) for k in range(a, b - 4)}
    for part in passages._band_batches([pa.record_batch({"text": pa.array(all_texts)})]):
        for key, node in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            keys[node].add(key)
    nodes = sorted(sets)
    alike = [(a, b) for a in nodes for b in nodes if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    met = [(a, b) for a, b in alike if keys[a] & keys[b]]
    links = [(r.a, r.b) for r in passages.alike(df, 0.8).collect()]
    assert len(met) > 30 and len(met) >= 0.9 * len(alike) and roots(nodes, links) == roots(nodes, met)
    assert all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in links)


def edited(rng, words, similarity):
    """The words with as many replaced as bring the five-word similarity down to about that."""
    out = list(words)
    sets = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    while True:
        after = list(out)
        after[rng.randrange(len(after))] = f"q{rng.getrandbits(30)}"
        a, b = sets(words), sets(after)
        if len(a & b) < similarity * len(a | b):
            return out
        out = after


def test_near_copies_recall(spark):
    """Unlike texts at 0.8 or just above are found, those below are not, alone and inside a family."""
    rng = random.Random(17)
    bodies, want = [], []
    for n in range(240):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([25, 60, 120, 400]))]
        bodies += [words, edited(rng, words, 0.8 if n % 2 else 0.9)]
        want.append((2 * n, 2 * n + 1))
    family = [f"w{rng.randrange(5000)}" for _ in range(200)]
    first = len(bodies)
    for _ in range(60):  # members are alike to few others
        bodies.append(edited(rng, edited(rng, family, 0.9), 0.9))
    order = rng.sample(range(len(bodies)), len(bodies))
    df = spark.createDataFrame([(order[i], " ".join(b)) for i, b in enumerate(bodies)], "doc_id long, text string")
    sets = [{tuple(b[k : k + 5]) for k in range(len(b) - 4)} for b in bodies]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    found = {r.doc_id: r.group_id for r in simhash.near_groups(df).collect()}
    assert sum(found[order[a]] == found[order[b]] for a, b in near) >= 0.97 * len(near)
    assert sum(found[order[a]] == found[order[b]] for a, b in want) >= 0.96 * len(want)
    exact = roots(range(len(bodies)), near)
    assert all(exact[order.index(i)] == exact[order.index(g)] for i, g in found.items()) and first + 60 == len(bodies)


def test_changes():
    ways = simhash.changes()
    assert len(set(ways)) == len(ways) == simhash.WAYS and ways[0] == () and {(r,) for r in range(simhash.WEAK)} <= set(ways)


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    center = rng.normal(size=(12, 24))
    x = np.concatenate([rng.normal(size=(400, 24)), *(c + 0.15 * rng.normal(size=(n, 24)) for c, n in zip(center, [2, 2, 3, 5, 8, 13, 20, 30, 2, 2, 90, 150], strict=True))]).astype(np.float32)
    rows = [(i, [float(v) for v in r], "l") for i, r in enumerate(x)]
    n = len(rows)
    rows += [(n, rows[0][1], "l"), (n + 1, [2 * v for v in rows[0][1]], "l"), (n + 2, None, "l"), (n + 3, [0.0] * 24, "l"), (n + 4, [float("nan")] * 24, "l"), (n + 5, [None] * 24, "l"), (n + 6, [1.0], "l"), (n + 7, [float("inf")] * 24, "l"), (n + 8, [], "l")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    good = [r for r in rows if r[1] and len(r[1]) == 24 and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1])]
    u = np.array([r[1] for r in good], dtype=np.float32).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    links = [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)]
    degree = collections.Counter(v for p in links for v in p)
    want = roots([r[0] for r in rows], links)
    found = {r.vec_id: r for r in neighbours.linked(df).collect()}
    assert len(found) == len(rows)
    recall = sum(min(found[i].n_links, degree[i]) for i in degree) / sum(degree.values())
    assert recall >= 0.99
    assert {i: (r.n_links, degree[i]) for i, r in found.items() if r.n_links > degree[i]} == {}
    assert sum(found[i].component_id == want[i] for i in found) >= len(rows) - 2
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert neighbours.linked(df.limit(0)).count() == 0


def test_neighbours_of_each_length_in_double(spark):
    """Lengths are apart; a cosine is that of the doubles, not of floats near them."""
    turn = lambda c: [c, (1 - c * c) ** 0.5, 0.0]
    rows = [(1, [1.0, 0.0, 0.0]), (2, turn(0.9 + 1e-9)), (3, turn(0.9 - 1e-9)[:1] + [-(1 - (0.9 - 1e-9) ** 2) ** 0.5, 0.0]), (4, [1.0, 0.0]), (5, [2.0, 0.0]), (6, [1.0]), (7, None)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (0, 7)}


def test_neighbours_in_pairs(spark, tmp_path):
    """Pairs just above the threshold that no third vector connects, in a table of 20,000."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(8)
    x = rng.normal(size=(20000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(1000, 48))
    away -= (away * x[:1000]).sum(axis=1, keepdims=True) * x[:1000]
    x[1000:2000] = 0.91 * x[:1000] + (1 - 0.91**2) ** 0.5 * away / np.linalg.norm(away, axis=1, keepdims=True)
    order = rng.permutation(len(x))
    place = np.argsort(order)
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x[order].astype(np.float32))}), tmp_path / "pairs.parquet")
    found = {r.vec_id: r for r in neighbours.linked(spark.read.parquet(f"file://{tmp_path}/pairs.parquet")).collect()}
    lost = [i for i in range(1000) if not (found[place[i]].n_links == found[place[i + 1000]].n_links == 1 and found[place[i]].component_id == found[place[i + 1000]].component_id)]
    assert len(lost) <= 10 and sum(r.n_links for r in found.values()) == 2 * (1000 - len(lost))


def test_quality(spark, docs, empty):
    rng = random.Random(3)
    good = [(i, " ".join(sentence(rng, 9) for _ in range(6))) for i in range(150)]
    junk = [(i, "\n".join(f"{w.upper()}!! ###" for w in sentence(rng, 60).split())) for i in range(150, 220)]
    every = spark.createDataFrame(good + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(220)], "doc_id long, quality int, toxic int")
    found = quality.classified(every, labels).collect()
    held = [r for r in found if r.held_out]
    assert held and sum(r.predicted == (r.doc_id < 150) for r in held) >= 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in found)
    table, bias = quality.fit(every, labels.select("doc_id", F.col("quality").alias("label")))
    odd = quality.score(docs, (table, bias), ["doc_id"]).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality.classified(every, labels.limit(0)).collect()} == {0.5}
    named = every.withColumn("score", F.lit("x"))
    assert {r.score for r in quality.score(named, (table, bias), named.columns, into="own").limit(3).collect()} == {"x"}
    with pytest.raises(ValueError):
        quality.score(named, (table, bias), named.columns)
    # the same sums, feature by feature, in plain Python
    import pyarrow as pa

    weight = np.frombuffer(table, dtype=np.float32)
    some = [t for _, t in good[:3] + junk[:3]] + ["", "a b a b"]
    for t, r in zip(some, quality.score(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"), (table, bias), ["doc_id"]).orderBy("doc_id").collect(), strict=True):
        own = np.concatenate([b for b, _ in quality.features(*texts.flat(pa.array([t])))] or [np.zeros(0, int)])
        raw = t.encode()
        assert len(own) == sum(max(0, len(raw) - n + 1) for n in (3, 5)) + len(t.split()) + max(len(t.split()) - 1, 1 if t.split() else 0) + sum(x == y for x, y in zip(t.split(), t.split()[1:], strict=False))
        logit = weight[own].astype(float).mean() if len(own) else 0.0
        assert math.isclose(r.score, 1 / (1 + math.exp(-(logit + bias))), rel_tol=1e-6)
    assert quality.classified(empty, labels).count() == 0


def test_language(spark, docs, empty):
    rng = random.Random(3)
    parts = {"aa": ["tion", "the", "ing", "er"], "bb": ["ung", "sch", "ein", "heit"], "cc": ["eau", "oux", "qué", "la"]}
    make = lambda p: " ".join("".join(rng.choice(p) for _ in range(rng.randint(1, 3))) for _ in range(40))
    rows = [(i, make(parts[k]), k) for i, k in enumerate(rng.choice(sorted(parts)) for _ in range(240))]
    rows += [(900, None, "aa"), (901, "12 34 !", "aa"), (902, "", None)]
    found = language.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held_out and r.doc_id < 900]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert {r.lang_pred for r in found if r.doc_id >= 900} == {"und"} and all(0 <= r.score <= 1 for r in found)
    # against plain compression with each dictionary
    import zstandard

    kept = spark.createDataFrame([r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2], "doc_id long, text string, lang string").select("text", "lang")
    known = language.learn(kept)
    how = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, **language.PARAMETERS)
    for r in found:
        text = next(t for i, t, _ in rows if i == r.doc_id)
        if r.lang_pred != "und":
            size = {k: len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(v, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how).compress(language.normalised(text))) for k, v in known.items()}
            assert r.lang_pred == min(sorted(size), key=size.get)
    assert language.identified(docs).count() == docs.count() and language.identified(empty).count() == 0
    assert language.has_letter("é") and not language.has_letter("½ ² ٣ _")


HEADERS = {
    "SPDX-License-Identifier: MIT": ["MIT"],
    "/* SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */": ["GPL-2.0-or-later WITH Classpath-exception-2.0"],
    "Copyright (c) 2020, X\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
    "copyright notice,\n   this list of conditions and the following disclaimer in the documentation.\n": ["BSD-2-Clause"],
    " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n"
    " * version 2.1 of the License, or (at your option) any later version.\n": ["LGPL-2.1-or-later"],
    "This is not an MIT license issue": [],
    "It is not licensed under the MIT License.": [],
    "Apache helicopters are used by the GPL crowd.": [],
    "GNU General Public License version 3": ["GPL-3.0"],
    "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007": ["GPL-3.0"],
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT\n * WARRANTY OF ANY KIND, EXPRESS OR IMPLIED": ["unknown"],
    "# This program is free\n# software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n"
    "# (at your option) any later version.\n#\n# This program is distributed in the hope that it will be useful,\n# but WITHOUT ANY WARRANTY.": ["GPL-3.0-or-later"],
    "some text Licensed under the Apache License, Version 2.0. More": ["Apache-2.0"],
    "License: Apache-2.0": ["Apache-2.0"],
    "text. All rights reserved.": ["proprietary"],
    "All rights reserved. " + "A sentence. " * 30 + "Released under the MIT License.": ["proprietary", "MIT"],
    "All rights reserved. Released under the MIT License.": ["MIT"],
    "The MIT License (MIT)\n\nCopyright (c) X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": ["MIT"],
}


@pytest.mark.parametrize("header", HEADERS)
def test_licence_headers(header):
    known = licence.automaton()
    assert [name for name, _ in licence.licences(licence.identified(header, known))] == HEADERS[header]
    wrapped = "\n".join(f"// {line}" for line in header.split("\n"))
    if not header.lstrip().startswith(("/*", "*", "#")):
        assert [name for name, _ in licence.licences(licence.identified(wrapped, known))] == HEADERS[header]


def test_licences(spark, docs, empty):
    full = "MIT License\n\n" + "\n\n".join(licence.SENTENCES[s] for s in ("mit-grant", "mit-notice", "mit-as-is")).replace(" ", "\n ")
    known = licence.automaton()
    names = ["title:MIT", "mit-grant", "mit-notice", "mit-as-is"]
    assert licence.licences(licence.identified(full, known)) == [("MIT", names)]
    assert licence.licences([(0, "apache-copy"), (1, "grant:Apache-2.0")]) == [("unknown", ["apache-copy"]), ("Apache-2.0", ["grant:Apache-2.0"])]
    df = spark.createDataFrame([(1, "x Licensed under CC BY-NC 4.0. Released under the MIT License.", "q"), (2, None, "q"), (3, "the licence of a licensee", "q")], "doc_id long, text string, licence string")
    assert [(r.doc_id, r.place, r.licence) for r in licence.scan(df).orderBy("place").collect()] == [(1, 0, "CC-BY-NC-4.0"), (1, 1, "MIT")]
    assert licence.scan(docs).count() == 0 and licence.scan(empty).count() == 0


def test_licence_sentences_in_comments():
    """A known sentence counts with a comment mark or mark-up between any two of its words."""
    known = licence.automaton()
    for name, wording in licence.SENTENCES.items():
        assert [i for _, i in licence.identified(f"some words {wording}, more", known)] == [name], name
        assert [i for _, i in licence.identified("\n * ".join(wording.replace("v. ", "").split()) if "v. " not in wording else wording, known)] == [name]
        assert [i for _, i in licence.identified("<br/>".join(wording.split(" ")), known)] == [name]


def test_licence_sentences_against_plain_search():
    """Identifiers and their order against a search of every wording in every sentence."""
    rng, known = random.Random(21), licence.automaton()
    plain = lambda x: " ".join(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", x.lower()))
    for _ in range(200):
        parts = [rng.choice([sentence(rng, rng.randint(1, 8)), rng.choice(list(licence.SENTENCES.values())) + "."]) for _ in range(rng.randint(1, 8))]
        parts = [p.replace("v. ", "") for p in parts]
        want = []
        for part in parts:
            hits = [(f" {plain(part)} ".find(f" {plain(w.replace('v. ', ''))} "), name) for name, w in licence.SENTENCES.items() if name != "mpl-terms"]
            want += [name for at, name in sorted(hits) if at >= 0]
        got = [i for _, i in licence.identified(rng.choice([" ", "\n", "\n\n", "\n# "]).join(parts), known) if i != "mpl-terms"]
        assert [g for g in got if not g.startswith("grant:")] == want


def test_fingerprints_are_recomputed(spark):
    """Anchors and sketches of whole texts against the definition, hash by hash."""
    rng = random.Random(12)
    some = [" ".join(f"w{rng.randrange(300)}" for _ in range(n)) for n in (0, 1, 4, 5, 6, 90, 900)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "i int, t string")
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    word = {w: signed(xxhash.xxh64_intdigest(w, 42)) for t in some for w in t.split()}
    runs = {tuple(word[w] for w in t.split()[j : j + n]) for t in some for n in (2, 5) for j in range(len(t.split()) - n + 1)}
    hashed = {}
    for n in (2, 5):
        own = [r for r in runs if len(r) == n]
        rows = spark.createDataFrame([(list(r),) for r in own], "r array<long>").select("r", F.xxhash64(*[F.col("r")[j] for j in range(n)]).alias("h")).collect()
        hashed |= {tuple(r.r): r.h for r in rows}
    for r in df.select("i", "t", syncmers.sketch(syncmers.anchors(F.col("t"))).alias("s")).collect():
        h = [word[w] for w in r.t.split()]
        want = []
        for j in range(len(h) - 4):
            inner = [hashed[tuple(h[j + x : j + x + 2])] for x in range(4)]
            if min(inner[0], inner[3]) <= min(inner[1:3]):
                want.append(hashed[tuple(h[j : j + 5])] % 2**64 >> 32)
        want = list(dict.fromkeys(want))
        if len(want) > syncmers.SKETCH:
            most = sorted(want)[syncmers.SKETCH - 1]
            want = [x for x in want if x <= most]
        if len(h) >= 5 or not h:
            assert r.s == want, r.i
        else:
            assert len(r.s) == 1


def test_links_of_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (None, [5.0, 5.0]), (7, [5.0, 5.01]), (None, [-1.0, 0.0]), (9, [0.0, 0.0])]
    found = neighbours.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (None, 1, 7, False), (7, 1, 7, True), (None, 0, None, False), (9, 0, 9, True)], key=str)


def test_every_licence_sign_passes(spark):
    """No known wording, name, title or tag is lost before it is looked for."""
    known = licence.automaton()
    for name, wording in licence.SENTENCES.items():
        for text in (wording, f"# {wording}\n".replace(" ", "\n# "), f"// {wording.upper()}."):
            assert name in [x for _, x in licence.identified(text, known)] or any("reserved" in x or ":" in x for _, x in licence.identified(text, known)), name
    names = ["GNU Lesser General Public License", "LGPL", "GNU Affero General Public Licence", "agpl", "General Public License", "GNU GPL", "gpl", "Apache License", "Apache", "MIT license", "MIT", "Expat License", "BSD 3-Clause", "3-clause BSD license",
             "New BSD License", "BSD 2-Clause License", "2-clause BSD", "Simplified BSD License", "FreeBSD License", "BSD", "ISC", "isc license", "Mozilla Public License", "MPL", "Eclipse Public License", "EPL", "Boost Software License", "BSL", "zlib", "zlib licence",
             "CC0", "Creative Commons Zero", "CC BY-NC-ND", "Creative Commons Attribution-NonCommercial-NoDerivatives", "CC-BY-NC-SA", "CC BY NC", "CC BY-ND", "CC-BY-SA", "CC BY", "Creative Commons Attribution"]
    for name in names:
        for text in (f"This work is released under {name}.", f"_{name}_ is what it is released under the {name}", f"Released\n * under the {name} 2.0"):
            assert any(x.startswith("grant:") for _, x in licence.identified(text, known)), text
    for text, want in {"Apache 2.0": ["Apache-2.0"], "SPDX-License-Identifier: (MIT OR Apache-2.0)": ["(MIT OR Apache-2.0)"], "Available under EPL 2.0.": ["EPL-2.0"],
                       "Licensed under either of Apache License, Version 2.0 or MIT license at your option.": ["Apache-2.0", "MIT"], "We drove under the bridge with mit and bsd.": []}.items():
        assert [x for x, _ in licence.licences(licence.identified(text, known))] == want, text


def test_scores_where_no_word_occurs_twice(spark):
    """The only training token is one text's end: it keeps most of the mass."""
    rows = [(i, t, None, None, 0, "", "", "", "") for i, t in ((2, None), (1, "a b"), (5, "c"))]
    for doc_id in range(2, 60):
        own = [(doc_id, None, *rows[0][2:])]
        train = [r for r in own if zlib.crc32(str(r[0]).encode()) % 7 != 2]
        if train:
            break
    found = ngram_lm.scored(spark.createDataFrame(own, COLUMNS)).first()
    assert found.train_tokens == 1 and found.score > -1.0


def test_passages_that_repeat_themselves(spark):
    """Shared stretches of short periods have cuts, too; so have long ones between foreign words."""
    rng = random.Random(21)
    foreign = lambda n: " ".join(f"f{rng.randrange(10**7)}" for _ in range(n))
    shared_ = {"na": "na " * 200, "five": "alpha beta gamma delta epsilon " * 40, "zero": "0 0 1 " * 80, "two": "left right " * 100, "seven": "a b c d e f g " * 30, "ten": "p q r s t u v w x y " * 12}
    rows = []
    for i, (name, text) in enumerate(shared_.items()):
        rows += [(10 * i, f"{foreign(40)} {text} {foreign(40)}"), (10 * i + 1, f"{foreign(33)} {text} {foreign(50)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: len(r.text.split()) for r in passages.without_repeats(docs).collect()}
    for i, (name, text) in enumerate(shared_.items()):
        words = len(text.split())
        assert out[10 * i] == 80 + words, name
        assert out[10 * i + 1] <= 83 + 0.2 * words, (name, out[10 * i + 1], words)


def test_settled_frames_are_let_go(spark, tmp_path):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 2) * 500 + j}" for j in range(90))) for i in range(60)], "doc_id long, text string")
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(folder))
    spans = passages.repeated(docs)
    assert spans.where("removed").count() >= 30
    left = set(os.listdir(folder)) - before
    assert len([x for x in left if x.startswith("settled-")]) == 1, left


def test_null_ids_are_not_held_out(spark):
    rows = [(None, "der hund und die katze sind im haus " * 5, "de"), (3, "the dog and the cat are in the house " * 5, "en"), (4, "the end of the day", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(3, 1), (None, 0)], "doc_id long, quality int")
    for found in (quality.classified(docs, labels), language.identified(docs), ngram_lm.scored(docs)):
        held = {r.doc_id: r.held_out for r in found.collect()}
        assert len(held) == 3 and held[None] is False and None not in held.values()
    assert {r.doc_id: r.lang_pred for r in language.identified(docs).collect()}[None] == "de"


def test_workers_give_freed_memory_back():
    """Freed blocks below a live one are returned to the system, not kept by the process that later stages share."""
    from pathlib import Path

    from spanloom.llm import texts

    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6

    blocks = [bytes([1]) * 60_000 for _ in range(4000)]
    pins = [bytes(600) for _ in range(1000)]
    high = resident()
    del blocks
    texts.give_back()
    assert resident() < high - 150 and len(pins) == 1000


def test_ngram_files_are_small(spark, tmp_path):
    """Logarithms take twelve bits, and blocks of a shard no more bytes than their entropy asks for."""
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 999, 1000):
        steps = rng.integers(0, ngram_lm.LEVELS, n).astype(np.uint16)
        made = ngram_lm.Steps.build("log", steps)
        assert (ngram_lm.Steps(*made.values())[np.arange(n)] == steps).all() and sum(x.nbytes for x in made.values()) == n + (n + 1) // 2
    code = np.unique(rng.integers(0, 1 << 20, 50_000) << ngram_lm.PLACES | rng.integers(0, 1 << 16, 50_000))
    below = np.minimum(rng.geometric(0.02, len(code)), 4095)
    block = ngram_lm._blocks(code, np.ones(len(code), np.int64), below, np.zeros(1, np.int64))
    shard, codes, counts, lower = next(iter(ngram_lm._merged([block], ngram_lm._unzipped)))
    assert shard == 0 and (codes == code).all() and (counts == 1).all() and (lower == below).all()
    share = np.bincount(below) / len(below)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum() / 8
    assert len(block.column("below")[0].as_py()) < 1.15 * entropy * len(code) and len(block.column("counts")[0].as_py()) < 0.01 * len(code)


def test_buckets_of_a_family_are_compared_once(spark):
    """Members of a family that meets in hundreds of nearly equal buckets are listed once, and all that meet are still compared."""
    from spanloom.llm import shared

    rng = random.Random(6)
    rows = {(k, n) for k in range(400) for n in rng.sample(range(300), 60)} | {(1000 + i, 5000 + i + j) for i in range(0, 40, 2) for j in range(3)}
    met = shared.settled(shared.buckets(spark.createDataFrame(sorted(rows), "key long, node long")))
    links = spark.createDataFrame([(1, 2), (5000, 5001)], "a long, b long")
    pairs, members = shared.parted_buckets(met, links)
    got = members.collect()
    compared = {frozenset((x.node, y.node)) for p in {r.pair for r in got} for x in got if x.pair == p and x.left for y in got if y.pair == p and y.right and y.component != x.component}
    keys = collections.defaultdict(list)
    for k, n in rows:
        keys[k].append(n)
    one = {1: 2, 2: 2, 5000: 5001, 5001: 5001}
    want = {frozenset((a, b)) for v in keys.values() if len(v) > 2 for a in v for b in v if a < b and one.get(a, a) != one.get(b, b)}
    assert want <= compared and pairs.count() == 0
    assert len(got) < 0.1 * met.count()  # before: more rows than memberships


def test_hubs(spark):
    rng = random.Random(4)
    rows = sorted({(rng.randrange(60), rng.randrange(80)) for _ in range(700)})
    from spanloom.llm import shared

    n, keys = collections.Counter(x for _, x in rows), collections.defaultdict(list)
    for k, x in rows:
        keys[k].append(x)
    want = {}
    for v in keys.values():
        top = max((n[x], x) for x in v)
        for x in v:
            if x != top[1]:
                want[x] = max(want.get(x, top), top)
    assert {r.a: r.b for r in shared.hubs(spark.createDataFrame(rows, "key long, node long")).collect()} == {x: t[1] for x, t in want.items()}


def test_hubs_join_nothing(spark):
    rows = spark.createDataFrame([(k, n) for k in range(5) for n in range(k, 9)], "key long, node long")
    assert "Join" not in shared.hubs(rows)._jdf.queryExecution().executedPlan().toString()


def test_rows_of_blocks_grow_less_than_the_square(spark, monkeypatch):
    """Members that nothing ties are given out as rows that grow with the power 1.5 of the bucket, and are all compared."""
    monkeypatch.setattr(shared, "BLOCK", 16)
    monkeypatch.setattr(shared, "BLOCK_ROOT", 2)
    monkeypatch.setattr(shared, "STRIP", 7)
    none = spark.createDataFrame([], "a long, b long")
    rows = {n: spark.range(n).selectExpr("1L AS key", "id AS node") for n in (400, 1600)}
    given = {n: shared.mixed_buckets(x, none).count() for n, x in rows.items()}
    assert given[1600] < 9 * given[400]  # before: 16 times
    near = lambda left, right: np.array([[x[0] == y[0] for y in right] for x in left])
    values = rows[400].selectExpr("node", "array(node % 150) AS v")
    found = shared.bucket_links(rows[400], none, values, near).collect()
    assert roots(range(400), [tuple(r) for r in found]) == roots(range(400), [(n, n % 150) for n in range(150, 400)])


def test_rounds_of_components_let_shuffles_go(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(shared, "shuffles_dropped", calls.append)
    order = list(range(700))
    random.Random(2).shuffle(order)
    links = list(zip(order[:-1], order[1:], strict=True))
    found = shared.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node for r in found} == set(order) and {r.component for r in found} == {0}
    assert calls


def test_components_of_stars_take_no_round(spark, monkeypatch):
    written, plain = [], shared.settled
    monkeypatch.setattr(shared, "settled", lambda frame, *more: written.append(frame) or plain(frame, *more))
    stars = spark.createDataFrame([(n, n % 7) for n in range(7, 90)], "a long, b long")
    found = shared.components(stars)
    assert {(r.node, r.component) for r in found.collect()} == {(n, n % 7) for n in range(90)}
    assert len(written) == 1  # before: a round to see that nothing changes
    again = shared.components(shared.tied(found).unionByName(spark.createDataFrame([(8, 2), (89, 90)], "a long, b long")))
    part = {n: min(n % 7, 1) if n % 7 in (1, 2) else n % 7 for n in range(90)}
    assert {(r.node, r.component) for r in again.collect()} == {*part.items(), (90, part[89])}


def test_a_round_of_components_runs_few_tasks(spark):
    """A chain of links: tasks of all rounds, with 4 shuffle partitions that nothing merges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("rounds", "")
    try:
        chain = spark.range(64).selectExpr("id AS a", "id + 1 AS b")
        assert {r.component for r in shared.components(chain).collect()} == {0}
        state = spark.sparkContext.statusTracker()
        stages = {k for j in state.getJobIdsForGroup("rounds") for k in state.getJobInfo(j).stageIds}
        tasks = sum(x.numCompletedTasks for k in stages if (x := state.getStageInfo(k)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks < 300  # 202; before 396


def test_elias_fano_finds_one_border_of_a_bucket(monkeypatch):
    """The first element not below a value, in dense and sparse stretches and runs over several words; one border is looked up, the other read off."""
    rng, asked, plain = np.random.default_rng(5), [], ngram_lm.EliasFano._zero
    monkeypatch.setattr(ngram_lm.EliasFano, "_zero", lambda self, k: asked.append(len(k)) or plain(self, k))
    dense = np.arange(10**9, 10**9 + 700)
    for values in (np.zeros(0, np.int64), np.array([0]), np.arange(300), np.sort(rng.choice(10**10, 3000, replace=False)), np.union1d(dense, rng.choice(10**12, 500))):
        held = ngram_lm.EliasFano(ngram_lm.EliasFano.build(values.astype(np.uint64)))
        sought = np.sort(np.concatenate([values, values + 1, rng.integers(0, 10**12, 400), [0, 2**40]]))
        asked.clear()
        at, exact = held.find(sought.astype(np.uint64))
        assert at.tolist() == np.searchsorted(values, sought).tolist() and exact.tolist() == np.isin(sought, values).tolist()
        assert sum(asked) < 1.7 * len(sought)  # before: twice


def test_places_of_passages_are_found_once(spark, monkeypatch):
    """The texts are read once for the places of repeated paragraphs, though keepers and runs both need them."""
    read, plain = spark.sparkContext.accumulator(0), passages._place_batches

    def counted(batches, wanted):
        def each():
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        yield from plain(each(), wanted)

    monkeypatch.setattr(passages, "_place_batches", counted)
    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 2) * 500 + j}" for j in range(90))) for i in range(60)], "doc_id long, text string")
    assert passages.repeated(docs).where("removed").count() >= 30
    assert read.value == 60


def test_words_around_paragraphs():
    """Surroundings are bytes of 32-bit numbers, nearest word first, and shared from there on."""
    import pyarrow as pa

    texts_ = ["", "alone", " ".join(f"w{i}" for i in range(150)) + "  ", "one two three"]
    batch = pa.record_batch({"doc_id": [1, 2, 3, 4], "mark": [5, 6, 7, 8], "text": texts_})
    every = np.full(1 << 14, -1, dtype=np.int64).tobytes()
    wanted = type("Sent", (), {"value": every})
    got = [r for b in passages._around_batches(iter([batch]), wanted) for r in b.to_pylist()]
    numbers = lambda raw: np.frombuffer(raw, np.int32).tolist()
    assert {r["doc_id"] for r in got} == {2, 3, 4}
    for r in got:
        text, words = texts_[r["doc_id"] - 1], texts_[r["doc_id"] - 1].split()
        begins, closes = numbers(r["begins"]), numbers(r["closes"])
        for i, at in enumerate(begins):
            k = r["first_word"] - 1 - i
            assert at == 0 if k == 0 else text[at:].startswith(words[k] + " ")
        assert len(begins) == min(passages.REACH, r["first_word"]) == len(numbers(r["before"]))
        if closes and len(closes) < passages.REACH:
            assert closes[-1] == len(text)
        assert len(closes) == len(numbers(r["after"]))
    lists = lambda *rows: pa.array([None if x is None else np.array(x, np.int32).tobytes() for x in rows], pa.binary())
    a, b, at = lists([1, 2, 3], [4], None, [5, 6], []), lists([1, 2, 9, 9], [4, 7], [1], [8], [3]), lists([10, 20, 30], [40], None, [50, 60], [])
    out = next(passages._reach_batches(iter([pa.record_batch({"a": a, "b": b, "p": at, "x": [0, 1, 2, 3, 4]})]), "a", "b", "p", "n", ["x"]))
    assert out.column("n").to_pylist() == [2, 1, 0, 0, 0] and out.column("n_byte").to_pylist()[:2] == [20, 40]


def test_runs_that_grow_back_to_one_word_are_all_found(spark):
    """A short run is followed by one whose keeper has the short one's words before it, too: both begin at one word then."""
    rng = random.Random(31)
    part = lambda n: " ".join(sentence(rng, 10) for _ in range(n))
    texts_, longer = {}, {}
    for i in range(60):
        short, long = part(2), part(5)
        texts_[3 * i] = f"{part(4)} {short} {part(4)}"
        texts_[3 * i + 1] = f"{part(3)} {short} {long} {part(4)}"
        texts_[3 * i + 2] = f"{part(5)} {short} {long} {part(3)}"
        longer[3 * i + 2] = texts_[3 * i + 2].index(long), texts_[3 * i + 2].index(long) + len(long)
    docs = spark.createDataFrame([*texts_.items(), *list(texts_.items())[:9]], "doc_id long, text string").repartition(5)
    spans = collections.defaultdict(list)
    found = passages.repeated(docs).where("removed").collect()
    for r in found:
        raw = texts_[r.doc_id].encode()
        spans[r.doc_id].append((len(raw[: r.begin].decode()), len(raw[: r.close].decode())))
    assert len(found) == len(set(found))
    held = [any(b <= begin + 12 and c >= close - 12 for b, c in spans[d]) for d, (begin, close) in longer.items()]
    assert sum(held) >= 0.97 * len(held), (sum(held), len(held))


def test_marks_leave_no_rows_with_the_driver(spark):
    """The set is a plain bit set of the leading bits, and the driver's Python holds little more than it."""
    import tracemalloc

    frame = spark.range(300_000).select((F.xxhash64("id")).alias("node"))
    few = [0, -1, 1, 2**63 - 1, -(2**63), 7, 7, 1 << 44]
    for nodes in (frame, spark.createDataFrame([(x,) for x in few], "node long"), frame.limit(0)):
        nodes = shared.settled(nodes)
        tracemalloc.start()
        held = shared.marks(nodes)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        values = np.array([r.node for r in nodes.collect()], dtype=np.int64).view(np.uint64)
        bits = len(held).bit_length() + 2
        plain = np.zeros(1 << bits, dtype=bool)
        plain[(values >> np.uint64(64 - bits)).astype(np.int64)] = True
        assert np.array_equal(np.unpackbits(np.frombuffer(held, np.uint8), bitorder="little"), plain)
        assert shared.marked(values, np.frombuffer(held, dtype=np.uint64)).all()
        assert most < 4 * len(held) + 2_000_000, (most, len(held))
