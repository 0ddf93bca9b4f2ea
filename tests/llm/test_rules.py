"""Quality rules: counts against brute force, exact bounds, realised risk, and odd rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import queries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    letters = re.findall("[A-Za-z]", text)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup,
        "n_repeat_words": len(hit), "n_lines": len(lines), "n_capitals": sum(x.isupper() for x in letters), "n_letters": len(letters),
    }


ODD = [None, "", " ", "\n", "\n\n\n", "a", "a\na", "a\n a", "a \na\na", "x y z w v", "x y z w v x y z w v", "a a a a a a", "é é é é é é é", "b\r\nb\r\n", "\nq\n\nq", "|#|<>", "a" * 9999, "word\n" * 3000, "　\x1c \x85 AbC"]


def test_counts():
    rng = random.Random(3)
    some = ODD + [rng.choice(["\n", " "]).join("".join(rng.choice("aé|B \n") for _ in range(rng.randint(0, 60))) for _ in range(3)) for _ in range(300)]
    for at in (some, some[3:], ["z"], []):
        found = rules.counts(pa.array(at, pa.string()))
        assert [{c: int(found[c][i]) for c in rules.COUNTS} for i in range(len(at))] == [plain(t) for t in at]


def test_exact_bound():
    for n, p in ((1, 0.5), (7, 0.3), (40, 0.0125), (300, 0.05)):
        for k in range(-0, n + 1, max(1, n // 9)):
            want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)
    assert rules.binomial_tail(9_000, 1_000_000, 0.0091) == pytest.approx(0.148, abs=0.02)


def test_cutoffs_hold_their_risk():
    rng = np.random.default_rng(1)
    limit, error, broken = 0.02, 0.05, 0
    shape = rng.dirichlet(np.ones(rules.LEVELS + 1) * 0.1)
    bad = rng.multinomial(300, shape[::-1])
    for _ in range(600):
        level = rules.cutoff(rng.multinomial(800, shape), bad, limit, error)
        broken += level is not None and shape[level:].sum() > limit
    assert broken / 600 <= error
    none = np.zeros(rules.LEVELS + 1)
    few, some = none.copy(), none.copy()
    few[0], some[9] = 100, 50
    assert rules.cutoff(few, some, limit, error) is None  # 100 good documents certify nothing at 2 %
    few[0] = 200
    assert rules.cutoff(few, some, limit, error) == 9
    assert rules.cutoff(few, none, limit, error) is None and rules.cutoff(none, some, limit, error) is None


def test_realised_rejections(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op12_quality_rules(spark, sf).toPandas()
    table = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    assert len(found) == len(table)
    rng = random.Random(0)
    for r in rng.sample(list(found.itertuples()), 300):
        want = plain(table.text[r.doc_id])
        assert {c: getattr(r, c) for c in want if c in found} == {c: want[c] for c in want if c in found}
        assert r.base_failed == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
    assert not (found.kept & found.base_failed).any()
    held = found[[zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]].set_index("doc_id").join(labels, how="inner")
    held = held[~held.base_failed]
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (~good.kept).mean() <= rules.RISK and len(good) > 300
    assert (~bad.kept).mean() >= 0.5


def test_odd_rows(spark):
    rows = [(i, t, None if i % 3 else "en", 1, "kept") for i, t in enumerate(ODD)] + [(None, "a b", "en", 0, "kept"), (5, "a", "en", 0, "kept"), (5, "a", "en", 0, "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, kept string")
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 1), (None, 1), (2, None)], "doc_id long, quality int")
    found = rules.filtered(docs, labels)
    assert found.count() == len(rows) and found.where("kept <> (NOT base_failed)").count() == 0
    assert rules.filtered(docs.where("false"), labels).count() == 0
    assert rules.filtered(docs, labels.where("false")).where("kept").count() == found.where("kept").count()


def test_strata_are_judged_apart(spark):
    """A rule that is certified in one stratum says nothing about another one with too few labels."""
    texts = {("en", 1): "some words of a text that is good " * 1, ("en", 0): "x| y| z| v| w| u| t| s| r| q| p|"}
    rows = [(i, texts["en", i % 2], "en" if i < 3000 else None) for i in range(3020)]
    docs = spark.createDataFrame([(i, t + " ten more here to be long enough", lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    found = rules.filtered(docs, labels).toPandas()
    assert (found[found.stratum.notna()].kept == (found.doc_id % 2 == 1)[found.stratum.notna()]).all()
    assert found[found.stratum.isna()].kept.all()
