"""The pipeline's stages on the smallest tables, each against a plain version of what it decides."""

import collections
import re

import pytest

import corpus_pipeline
from spanloom.llm import mixing, packing, quality

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    out, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    top = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"file://{top}/{name}")
        after = spark.read.parquet(f"file://{top}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns(stages):
    columns = stages["quality"][0].columns
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "packing")


def test_quality(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(before, labels.selectExpr("doc_id", "quality AS label"))
    want = {r.doc_id for r in quality.score(before, model, ["doc_id"]).collect() if r.score >= quality.THRESHOLD}
    assert set(by_id(after)) == want
    marked = {r.doc_id: r.quality for r in labels.collect()}
    kept = [marked[i] for i in by_id(before) if i in marked and i in want]
    assert sum(kept) >= 0.95 * sum(v for i, v in marked.items() if i in by_id(before)) and kept.count(0) <= 1


def test_near_copies(stages):
    before, after = map(by_id, stages["near_copies"])
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := WORD.findall(r.text.lower())) else set() for i, r in before.items()}
    alike = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
    ids = sorted(before)
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if alike(a, b) >= 0.8]
    assert not [1 for a, b in near if before[a].text == before[b].text and a in after and b in after]
    unequal = [(a, b) for a, b in near if before[a].text != before[b].text]
    assert sum(a in after and b in after for a, b in unequal) <= 0.1 * len(unequal)
    assert all(max(alike(i, k) for k in ids if k != i) >= 0.8 for i in ids if i not in after)


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and repeated rows, clashing names; and an empty table."""
    words = lambda n, k: " ".join(f"w{(i * k) % 97}" for i in range(n))
    rows = [(1, words(80, 3), "en", "s", 9, "a", "b"), (2, words(80, 3), None, None, None, None, None), (None, words(40, 5), "en", "s", 1, "a", "b"), (None, None, None, None, None, None, None),
            (3, "", "en", "s", 0, "a", "b"), (3, "", "en", "s", 0, "a", "b"), (4, None, "en", "s", 0, "a", "b"), (5, words(6000, 7), "en", "s", 2, "a", "b"), (5, words(6000, 7), "en", "s", 2, "a", "b")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, mark string"
    for name, some in (("odd", rows), ("none", [])):
        docs = spark.createDataFrame(some, schema)
        for i, (stage, run) in enumerate(corpus_pipeline.STAGES):
            run(spark, docs, SF).write.parquet(f"file://{tmp_path}/{name}{i}")
            after = spark.read.parquet(f"file://{tmp_path}/{name}{i}")
            if stage != "packing":
                assert after.columns == docs.columns
            if stage == "near_copies" and some:
                assert len({(r.doc_id, r.text) for r in after.collect()}) == after.count()
            docs = after
        assert docs.count() > 0 if some else docs.count() == 0


def test_passages(stages):
    before, after = map(by_id, stages["passages"])
    windows = lambda rows: collections.Counter(w for r in rows.values() for w in {tuple(x[k : k + 51]) for x in [WORD.findall(r.text)] for k in range(len(x) - 50)})
    repeated = [w for w, n in windows(before).items() if n > 1]
    left = windows(after)
    assert sum(left[w] > 1 for w in repeated) <= 0.05 * len(repeated)
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        if r.text != before[i].text:
            assert len(r.text) < len(before[i].text)
    words = collections.Counter(t for r in before.values() for t in {tuple(x[k : k + 16]) for x in [WORD.findall(r.text.lower())] for k in range(len(x) - 15)})
    clean = [i for i, r in before.items() if not any(words[tuple(x[k : k + 16])] > 1 for x in [WORD.findall(r.text.lower())] for k in range(max(0, len(x) - 15)))]
    assert sum(i not in after or after[i].text != before[i].text for i in clean) <= 0.02 * len(clean)


def test_mixing(stages):
    before, after = stages["mixing"]
    want = {r.doc_id: (r.size, r.taken) for r in mixing.mixed(before, ["doc_id"]).collect()}
    times = collections.Counter(r.doc_id for r in after.collect())
    for i, (size, taken) in want.items():
        assert times[i] == (int(taken / size + 0.5) if size else 0)


def test_packing(stages):
    before, after = stages["packing"]
    texts = [r.text for r in before.collect()]
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.default_tokenizer())
    tokens = sum(len(e.ids) + 1 for e in coder.encode_batch_fast(texts, add_special_tokens=False))
    rows = after.toPandas()
    assert rows.length.sum() == tokens and rows.groupby("sequence_id").length.sum().max() <= 1024
