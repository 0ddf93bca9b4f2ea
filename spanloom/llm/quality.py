"""A quality classifier on averaged subword embeddings with a softmax output.

Features of a text are its character 3-grams and 5-grams (of UTF-8 bytes), its words, its word pairs and
its immediate word repetitions, all hashed into one table. Their learned vectors are averaged and go
through a softmax; vectors and output are fitted by stochastic gradient descent in numpy, in one task, on
at most ``SAMPLE`` labelled rows. Since the average comes before a linear output, each table row's
contribution to the logit is one number; scoring looks only those up and needs no shuffle.

Defined results: null and empty texts have no features and get the score of the output's bias; texts are
scored whole, however long; repeated rows get equal scores; a null id is not held out, and has no label; extra columns are ignored; without any
labelled row to learn from every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spanloom.llm import texts
from spanloom.llm.shared import crc_remainder

#: Labelled rows that are learned from, at most.
SAMPLE = 3000
BUCKET_BITS = 16
DIM = 8
THRESHOLD = 0.3


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Groups of (buckets, each text's first with the end); the groups together are the texts' features."""
    shift = np.uint32(32 - BUCKET_BITS)
    out = []
    byte = data.astype(np.uint32) + np.uint32(1)
    for n, salt in ((3, 0x85EBCA6B), (5, 0xC2B2AE35)):
        count = np.maximum(0, np.diff(offsets) - n + 1)
        firsts = np.concatenate([[0], np.cumsum(count)])
        if not firsts[-1]:
            continue
        code = np.zeros(len(data) - n + 1, dtype=np.uint32)
        for j in range(n):
            code = code * np.uint32(0x01000193) ^ byte[j : len(data) - n + 1 + j] * np.uint32(0x9E3779B1)
        inside = np.ones(len(data), dtype=bool)
        for back in range(1, n):
            at = offsets[1:] - back
            inside[at[at >= offsets[:-1]]] = False
        code = code[inside[: len(code)]] * np.uint32(salt)
        out.append(((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift, firsts))
    starts, ends, firsts = texts.word_bounds(data, offsets)
    word = texts.word_hashes(data, starts, ends)
    wide = np.uint64(64 - BUCKET_BITS)
    if len(word):
        out.append(((word >> wide).astype(np.uint32), firsts))
        pair, pairs = texts.shingles(word, firsts, 2)
        out.append(((pair >> wide).astype(np.uint32), pairs))
        same = np.zeros(len(word), dtype=bool)
        same[1:] = word[1:] == word[:-1]
        same[firsts[:-1][firsts[:-1] < len(word)]] = False
        # a repetition is a feature whatever the word; it takes one fixed bucket
        out.append((np.full(int(same.sum()), 12345, dtype=np.uint32), np.concatenate([[0], np.cumsum(same)])[firsts]))
    return out


def _counted(batches):
    """Label, distinct buckets and their shares for each text."""
    for batch in batches:
        for part in texts.slices(batch):
            groups = features(*texts.flat(part.column("text")))
            buckets, shares = [], []
            for i in range(part.num_rows):
                own = [b[f[i] : f[i + 1]] for b, f in groups]
                own = np.concatenate(own) if own else np.zeros(0, np.uint32)
                found, n = np.unique(own, return_counts=True)
                buckets.append(found.astype(np.int32))
                shares.append((n / max(1, len(own))).astype(np.float32))
            arrays = [part.column("label"), part.column("turn"), pa.array(buckets, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "turn", "buckets", "shares"])


def _fit(batches, classes: int = 2, seed: int = 7):
    """Yield the logit contribution of each bucket (float32 bytes) and the bias."""
    labels, turns, buckets, shares = [], [], [], []
    for batch in batches:
        labels += batch.column("label").to_pylist()
        turns += batch.column("turn").to_pylist()
        for name, into in (("buckets", buckets), ("shares", shares)):
            into += [x.values.to_numpy(zero_copy_only=False) for x in batch.column(name)]
    if not labels:
        return
    order = np.argsort(np.array(turns), kind="stable")
    size = 1 << BUCKET_BITS
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (size, DIM)).astype(np.float32)
    output = np.zeros((DIM, classes), dtype=np.float32)
    bias = np.zeros(classes, dtype=np.float32)
    target = np.eye(classes, dtype=np.float32)[np.array(labels)]
    width = 16
    epochs = int(np.clip(24000 // len(labels), 8, 80))
    steps, step = epochs * -(-len(labels) // width), 0
    for _ in range(epochs):
        turn = rng.permutation(order)
        for at in range(0, len(turn), width):
            rows = turn[at : at + width]
            lengths = np.array([len(buckets[i]) for i in rows])
            b = np.concatenate([buckets[i] for i in rows])
            share = np.concatenate([shares[i] for i in rows])
            owner = np.repeat(np.arange(len(rows)), lengths)
            vectors = table[b] * share[:, None]
            hidden = np.stack([np.bincount(owner, vectors[:, d], len(rows)) for d in range(DIM)], axis=1).astype(np.float32)
            logits = hidden @ output + bias
            logits -= logits.max(axis=1, keepdims=True)
            odds = np.exp(logits)
            error = (odds / odds.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            rate = np.float32(4.0 * (1 - step / steps))
            back = error @ output.T
            output -= rate * hidden.T @ error
            bias -= rate * np.float32(0.05) * error.sum(axis=0)
            np.subtract.at(table, b, rate * np.float32(40) * back[owner] * share[:, None])
            step += 1
    logit = table @ (output[:, 1] - output[:, 0])
    del buckets, shares
    yield pa.RecordBatch.from_arrays(
        [pa.array([logit.astype(np.float32).tobytes()], pa.binary()), pa.array([float(bias[1] - bias[0])])], names=["table", "bias"]
    )
    texts.give_back()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[bytes, float]:
    """Fit on at most ``sample`` rows of ``labels`` (doc_id, label 0 or 1); returns a table of fixed size and a bias.

    The rows are those whose ids hash lowest; a document with two labels counts with the higher one. Only
    this bounded sample meets in one task.
    """
    some = labels.where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    some = some.withColumn("turn", F.xxhash64("doc_id")).orderBy("turn", "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("label", "turn", "text")
    counted = rows.mapInArrow(_counted, "label int, turn long, buckets array<int>, shares array<float>")
    model = counted.repartition(1).mapInArrow(_fit, "table binary, bias double").first()
    return (bytes(model[0]), model[1]) if model else (np.zeros(1 << BUCKET_BITS, np.float32).tobytes(), 0.0)


def _score_batches(batches, table, bias: float, keep: list[str], into: str):
    weight = np.frombuffer(table.value, dtype=np.float32)
    for batch in batches:
        for part in texts.slices(batch):
            total, count = np.zeros(part.num_rows), np.zeros(part.num_rows)
            for buckets, firsts in features(*texts.flat(part.column("text"))):
                run = np.concatenate([[0.0], np.cumsum(weight[buckets], dtype=np.float64)])
                total += run[firsts[1:]] - run[firsts[:-1]]
                count += np.diff(firsts)
            score = 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -50, 50)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(score)], names=[*keep, into])


def score(docs: DataFrame, model: tuple[bytes, float], keep: list[str], into: str = "score") -> DataFrame:
    """The columns ``keep`` and, as ``into``, the probability of label 1; reads the column ``text``."""
    if into in keep:
        raise ValueError(f"{into} is a column that is kept; name another")
    table = docs.sparkSession.sparkContext.broadcast(model[0])
    kept = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])
    schema = StructType([*(docs.schema[c] for c in keep), StructField(into, DoubleType())])
    return kept.mapInArrow(partial(_score_batches, table=table, bias=model[1], keep=keep, into=into), schema)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), learned from the labels of documents that are not held out."""
    held_out = F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False))
    learn = labels.where(~held_out).select("doc_id", F.col("quality").alias("label"))
    return score(docs, fit(docs, learn), ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
