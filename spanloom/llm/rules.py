"""Quality rules whose thresholds are risk-controlled on labelled documents.

Each rule is a ratio of a document's counts, cut at one of ``LEVELS`` fixed levels from lenient to strict. In each
stratum (language) and for each rule the levels are tested in that order on the labelled holdout: a level is certified
while the exact binomial tail P(Bin(good, limit) <= rejected) stays at or below the error allowed, so that with
that confidence it rejects no more than ``limit`` of the good documents. ``risk`` is shared out over the rules, so
the documents that any rule rejects stay within it, and the error over rules and strata (Bonferroni); along a
rule's levels the order is fixed, which needs no further correction. Of the certified levels the one that
separates the labels best becomes the cutoff, the more lenient in a tie. A rule that does not separate them, and
a stratum with too few labels to certify anything, get none and reject nothing.

Labels of documents whose crc32(doc_id) mod 5 is 0 are not used; tests audit the realised rejections on them.

Defined results: a null text has no words; a null language is a stratum of its own; null ids and ids without
a label are judged, too; repeated rows are judged alike, and count as often as they occur; of several labels of
an id the higher one counts; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm import texts
from spanloom.llm.shared import crc_remainder, settled

#: Least words of a document, and the hundredths of its words that may be repeated, before any label is asked.
LEAST_WORDS, MOST_REPEATED = 10, 20
WINDOW = 5
#: Good documents that the rules together may reject in a stratum, and the chance that they reject more.
RISK, ERROR = 0.05, 0.05
LEVELS = 32
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters"]


def rules() -> dict[str, Column]:
    """Each rule's level: how many of its cutoffs, from lenient to strict, reject a document of these counts."""
    words = F.greatest("n_words", F.lit(1))
    per_word = F.col("word_chars") / words

    def doubling(ratio: Column, strictest: float) -> Column:
        """Cutoffs from ``strictest`` upwards by a factor of 2^(1/4) each: the ratio is rejected above them."""
        return F.when(ratio > strictest, F.ceil(F.log2(ratio / strictest) * 4)).otherwise(0)

    return {
        "symbols": doubling(F.col("n_symbols") / words, 0.02),
        "long_words": doubling(per_word, 5.0),
        "short_words": F.when(F.col("n_words") > 0, doubling(1 / per_word, 0.15)).otherwise(0),
        "lines": doubling(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), 0.02),
        "repeats": doubling(F.col("n_repeat_words") / words, 0.005),
        "capitals": doubling(F.col("n_capitals") / F.greatest("n_letters", F.lit(1)), 0.05),
    }


def _firsts(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (owner, value): whether an equal one stands before it, and whether one stands before or after it."""
    order = np.lexsort((value, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (value[order][1:] == value[order][:-1])
    later, both = np.zeros(len(owner), dtype=bool), np.zeros(len(owner), dtype=bool)
    later[order[1:][same]] = True  # the order is stable: the first of equals keeps its place
    both[order[1:][same]] = True
    both[order[:-1][same]] = True
    return later, both


def counts(texts_: pa.Array) -> dict[str, np.ndarray]:
    """The ``COUNTS`` of each text."""
    data, offsets = texts.flat(texts_)
    n = len(offsets) - 1
    starts, ends, firsts = texts.word_bounds(data, offsets)
    point = (data & 0xC0) != 0x80
    total = lambda flags, a, b: (lambda run: run[b] - run[a])(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)]))
    chars = np.concatenate([[0], np.cumsum(total(point, starts, ends))])
    out = {"n_words": np.diff(firsts), "word_chars": chars[firsts[1:]] - chars[firsts[:-1]], "n_symbols": total(_SYMBOL[data], offsets[:-1], offsets[1:])}
    out["n_capitals"] = total((data >= 65) & (data <= 90), offsets[:-1], offsets[1:])
    out["n_letters"] = total((texts.LOWER[data] >= 97) & (texts.LOWER[data] <= 122), offsets[:-1], offsets[1:])
    # lines: a text is followed by a line end, as it were
    line_ends = np.flatnonzero(data == 10)
    begins = np.concatenate([offsets[:-1], line_ends + 1])
    stops = np.concatenate([line_ends, offsets[1:]])
    owner = np.concatenate([np.arange(n), np.searchsorted(offsets, line_ends, side="right") - 1])
    begins, line_owner = begins[np.lexsort((begins, owner))], np.sort(owner)
    stop_owner = np.concatenate([np.searchsorted(offsets, line_ends, side="right") - 1, np.arange(n)])
    stops = stops[np.lexsort((stops, stop_owner))]
    inked = np.searchsorted(starts, stops) > np.searchsorted(starts, begins)
    begins, stops, line_owner = begins[inked], stops[inked], line_owner[inked]
    later, _ = _firsts(line_owner, texts.word_hashes(data, begins, stops) if len(data) else np.zeros(0, np.uint64))
    out["n_lines"] = np.bincount(line_owner, minlength=n)
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=n)
    # windows: a word counts if any window over it is found again
    long = np.diff(firsts) >= WINDOW
    windows, first_window = texts.shingles(texts.word_hashes(data, starts, ends) if len(data) else np.zeros(0, np.uint64), firsts, WINDOW)
    in_text = np.repeat(np.arange(n), np.diff(first_window))
    _, again = _firsts(in_text, windows)
    again &= long[in_text]
    at = (firsts[:-1][in_text] + np.arange(len(windows)) - first_window[:-1][in_text])[again]
    cover = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    out["n_repeat_words"] = covered[firsts[1:]] - covered[firsts[:-1]]
    return out


def _count_batches(batches, keep: list[str]):
    for batch in batches:
        for part in texts.slices(batch):
            found = counts(part.column("text"))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(found[c].astype(np.int64)) for c in COUNTS)], names=[*keep, *COUNTS])


def counted(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, the counts, base_failed) of each document; reads whole texts once."""
    rows = docs.select("doc_id", F.col(f"`{stratum}`").cast("string").alias("stratum"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, stratum string, " + ", ".join(f"{c} long" for c in COUNTS)
    rows = rows.mapInArrow(lambda batches: _count_batches(batches, ["doc_id", "stratum"]), schema)
    return rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed downwards from k or, above the mean, from its complement; exact to rounding."""
    if k >= n:
        return 1.0

    def run(start: int, step: int) -> float:
        term = math.exp(math.lgamma(n + 1) - math.lgamma(start + 1) - math.lgamma(n - start + 1) + start * math.log(p) + (n - start) * math.log1p(-p))
        total, i = term, start
        while 0 <= i + step <= n and term > total * 1e-17:
            term *= (i / (n - i + 1) * (1 - p) / p) if step < 0 else ((n - i) / (i + 1) * p / (1 - p))
            i += step
            total += term
        return total

    return run(k, -1) if k <= n * p else 1.0 - run(k + 1, 1)


def cutoff(good: np.ndarray, bad: np.ndarray, limit: float, error: float) -> int | None:
    """The level of one rule in one stratum, from its histograms of levels (index: level) for good and bad documents.

    Levels are tested from the most lenient (the last) down; the first that fails ends the tests.
    """
    n, m = int(good.sum()), int(bad.sum())
    best, chosen, rejected, caught = 0.0, None, 0, 0
    for level in range(len(good) - 1, 0, -1):
        rejected, caught = rejected + int(good[level]), caught + int(bad[level])
        if binomial_tail(rejected, n, limit) > error or not n:
            break
        gain = caught / m - rejected / n if m else 0.0
        if gain > best + 1e-12:
            best, chosen = gain, level
    return chosen


def cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, one level or null for each rule) from ``labelled``: stratum, label 0 or 1, and the counts.

    Only histograms, at most ``LEVELS`` + 1 rows for each stratum, rule and label, leave the documents.
    """
    names = list(rules())
    levels = [F.struct(F.lit(name).alias("rule"), F.least(level, F.lit(LEVELS)).cast("int").alias("level")) for name, level in rules().items()]
    rows = labelled.select("stratum", "label", F.explode(F.array(*levels)).alias("r")).groupBy("stratum", "label", "r.rule", "r.level").agg(F.count("*").alias("n"))
    strata = rows.select("stratum").distinct().agg(F.count("*").alias("strata"))
    limit = risk / len(names)

    def choose(table: pd.DataFrame) -> pd.DataFrame:
        out = {"stratum": table["stratum"].iloc[0]}
        allowed = error / (len(names) * int(table["strata"].iloc[0]))
        for name, own in table.groupby("rule"):
            bars = {label: np.bincount(x["level"], x["n"], minlength=LEVELS + 1) for label, x in own.groupby("label")}
            none = np.zeros(LEVELS + 1)
            out[name] = cutoff(bars.get(1, none), bars.get(0, none), limit, allowed)
        return pd.DataFrame([out]).reindex(columns=["stratum", *names])

    return rows.crossJoin(strata).groupBy("stratum").applyInPandas(choose, "stratum string, " + ", ".join(f"{c} int" for c in names))


def judged(stats: DataFrame, cuts: DataFrame) -> DataFrame:
    """``stats`` (of ``counted``) with ``broken``, the names of the rules a document breaks, and ``kept``."""
    cuts = cuts.select(F.col("stratum").alias("of"), *[F.col(c).alias(f"cut_{c}") for c in rules()])
    rows = stats.join(cuts, F.col("stratum").eqNullSafe(F.col("of")), "left")
    broken = [F.when(F.least(level, F.lit(LEVELS)) >= F.col(f"cut_{name}"), F.lit(name)) for name, level in rules().items()]
    rows = rows.select(*stats.columns, F.array_compact(F.array(*broken)).alias("broken"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def filtered(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The counts of all documents and whether they are kept; ``labels`` holds doc_id and quality, 0 or 1."""
    stats = settled(counted(docs, stratum))
    known = labels.where("quality in (0, 1)").where(crc_remainder("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    labelled = stats.where("NOT base_failed").join(known, "doc_id")
    return judged(stats, settled(cutoffs(labelled, risk, error)))
