"""Spelling variants against brute force, and at their edges."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from spanloom.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(x, key=lambda y: (-n[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def corpus(rng, size):
    base = ["".join(rng.choice("abcdeéÉßöÿ") for _ in range(rng.randint(5, 9))) for _ in range(30)]
    pool = list(base)
    for w in base:
        for _ in range(4):
            k = rng.randrange(len(w))
            pool.append(rng.choice([w[:k] + w[k + 1 :], w[:k] + "a" + w[k:], w[:k] + "b" + w[k + 1 :]]))
    weights = [rng.choice([1, 6, 30, 150]) for _ in pool]
    return [(i, " ".join(rng.choices(pool, weights, k=60)).title() + " x1 " + "y" * 6000) for i in range(size)]


def test_variants(spark):
    rng = random.Random(2)
    rows = corpus(rng, 120)
    rows += [(None, rows[0][1]), (None, "fulano " * 9), (7, None), (8, ""), rows[3], rows[3], (-1, "×÷×÷×÷ " * 6 + "ŒŒœœabcdef " * 6)]
    rows += [(200 + i, " ".join(["qqqqqq"] * 50 + ["qqqqqw"] * 6 + ["qqqqww"])) for i in range(6)]
    docs = spark.createDataFrame([(*r, "word", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    want = plain(rows)
    assert len(want) > 60 and any(r[1] and r[1] != r[2] for r in want)
    for piece in (spelling.PIECE, 3):
        found = spelling.variants(docs, piece=piece).collect()
        assert found and set(map(tuple, found)) == want and len(found) == len(want)
    assert spelling.variants(docs.where("false")).count() == 0


def test_near_of_long_and_odd_words():
    rng = random.Random(5)
    long = "".join(rng.choice("abcé") for _ in range(5000))
    some = ["abcdef", "abcdeg", "abcdefg", "bacdef", "a", "", "b", "é", "éa", long, long[:77] + "z" + long[78:], long[:4000] + long[4001:], long[::-1]]
    letters = spelling.Letters(pa.array(some))
    i, j = spelling.near(letters, letters, same=True)
    assert {(int(a), int(b)) for a, b in zip(i, j, strict=True)} == {(a, b) for a in range(len(some)) for b in range(a + 1, len(some)) if one_edit(some[a], some[b])}
    assert np.array_equal(letters.lengths, [len(w) for w in some])


def test_chains_of_forms(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w5"), ("y", "z")]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {w: "z" if w == "y" else "w37" for w, _ in chain}
    assert spelling.roots(spark.createDataFrame([], "word string, form string")).count() == 0
