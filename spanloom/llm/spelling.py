"""Spelling variants of a corpus's words: blocked Gram matrices of letter counts, then verified edits.

Words within one edit of each other have letter counts at a squared distance of at most two, and lengths that
differ by at most one. Words are dealt to blocks of equal length and equal counts of ``GROUPS`` groups of
letters; a block meets those blocks only that one edit can lead to. Within a pair of blocks numpy products of
the letter-count matrices give all squared distances, pairs at two or less are kept, and their edit is verified
letter by letter. A block of more than ``PIECE`` words is cut into pieces by hash, so no task holds more than one
piece and one batch of its visitors. Words, not their occurrences, are compared; only near pairs leave a task.

Defined results: a null text has no words, a null id counts as an empty one in the hash; texts are read whole;
repeated rows count as often as they occur; extra columns are ignored; an empty table gives no words. Of near
words with equal counts the smallest in code-point order is the form.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import texts
from spanloom.llm.shared import released, settled

#: Letters are told apart by their code point modulo this, both in the counts and in the groups.
COLUMNS = 32
GROUPS = 6
#: Words of one piece of a block.
PIECE = 2048
#: Letters of pairs that are verified at a time.
VERIFIED = 1 << 21
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, every: int = 199, least_length: int = 6, least_n: int = 5) -> DataFrame:
    """(word, n): words of the texts with their occurrences, after one letter of every ``every``-th (id, run) is lost."""
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit("([a-zÀ-ÿ]+)"), F.lit(1))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    # a run that loses a letter needs one more of them
    rows = rows.where(F.char_length("run") >= least_length).withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = F.pmod("h", F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    rows = rows.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return rows.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


class Letters:
    """The letters of some words, one byte for each code point (all are below 256), and their counts."""

    def __init__(self, column: pa.Array):
        data, offsets = texts.flat(column)
        lead = data == 0xC3
        second = np.zeros(len(data), dtype=bool)
        second[1:] = lead[:-1]
        before = np.concatenate([[0], np.cumsum(~lead)])
        self.data = np.where(second, (data & 0x3F) | 0xC0, data)[~lead].astype(np.uint8)
        self.offsets = before[offsets]
        self.lengths = np.diff(self.offsets)
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.counts = np.bincount(owner * COLUMNS + self.data % COLUMNS, minlength=len(self.lengths) * COLUMNS).reshape(-1, COLUMNS)

    def rows(self, of: np.ndarray, width: int) -> np.ndarray:
        """The first ``width`` letters of the words ``of``, which have that many."""
        return self.data[self.offsets[of][:, None] + np.arange(width)]


def one_edit(a: Letters, i: np.ndarray, b: Letters, j: np.ndarray) -> np.ndarray:
    """Which pairs (i of a, j of b), of lengths that differ by at most one, are exactly one edit apart."""
    out = np.zeros(len(i), dtype=bool)
    la, lb = a.lengths[i], b.lengths[j]
    for short, s, long, t, of in ((a, i, b, j, la <= lb), (b, j, a, i, la > lb)):
        for width in np.unique(short.lengths[s[of]]):
            for more in (0, 1):
                some = np.flatnonzero(of & (short.lengths[s] == width) & (long.lengths[t] == width + more))
                step = max(1, VERIFIED // max(1, int(width)))
                for at in range(0, len(some), step):
                    pick = some[at : at + step]
                    x, y = short.rows(s[pick], width), long.rows(t[pick], width + more)
                    if more:
                        head = np.cumprod(x == y[:, :-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
                        tail = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
                        out[pick] = head + tail >= width
                    else:
                        out[pick] = (x != y).sum(axis=1) == 1
    return out


def near(a: Letters, b: Letters, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of a, of b) one edit apart; of one list with itself, each pair once."""
    if not len(a.lengths) or not len(b.lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # squares of counts are exact in single precision up to 2^24
    kind = np.float32 if max(a.lengths.max(), b.lengths.max()) <= 2000 else np.float64
    x, y = a.counts.astype(kind), b.counts.astype(kind)
    one = np.ones((len(x), 1), kind), np.ones((len(y), 1), kind)
    x = np.hstack([x, (x * x).sum(axis=1, keepdims=True), one[0]])
    y = np.hstack([-2 * y, one[1], (y * y).sum(axis=1, keepdims=True)])
    i, j = np.nonzero(x @ y.T <= 2.5)
    keep = np.abs(a.lengths[i] - b.lengths[j]) <= 1
    if same:
        keep &= i < j
    i, j = i[keep], j[keep]
    keep = one_edit(a, i, b, j)
    return i[keep], j[keep]


_SALTS = texts.mix(np.arange(1, GROUPS + 1, dtype=np.uint64))


def _filed(batches):
    """Each word under its own block (home), and as a visitor under the larger ones of the blocks one edit away."""
    minus, plus = np.nonzero(~np.eye(GROUPS + 1, dtype=bool))  # the last group stands for none: an insertion or a deletion
    salts = np.concatenate([_SALTS, np.zeros(1, np.uint64)])
    for batch in batches:
        if not batch.num_rows:
            continue
        letters = Letters(batch.column("word"))
        groups = np.zeros((batch.num_rows, GROUPS + 1), dtype=np.int64)
        for c in range(COLUMNS):
            groups[:, c % GROUPS] += letters.counts[:, c]
        groups[:, GROUPS] = 1
        code = (groups[:, :GROUPS].astype(np.uint64) * _SALTS).sum(axis=1, dtype=np.uint64)
        own = texts.mix(code).astype(np.int64)
        other = texts.mix(code[:, None] + (salts[plus] - salts[minus])).astype(np.int64)
        word, move = np.nonzero((groups[:, minus] > 0) & (other > own[:, None]))
        rows = np.concatenate([np.arange(batch.num_rows), word])
        block = np.concatenate([own, other[word, move]])
        home = np.arange(len(rows)) < batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(home), batch.column("word").take(pa.array(rows)), batch.column("n").take(pa.array(rows))], names=["block", "home", "word", "n"])
    texts.give_back()


def _met(batches):
    """Near words of each cell, both ways, from rows sorted by (block, piece, visitors after those at home)."""
    last, home, column = None, [], None

    def found(a: pa.Table, b: pa.Table, same: bool):
        x = Letters(a.column("word").combine_chunks())
        for at in range(0, b.num_rows, PIECE):
            part = b.slice(at, PIECE)
            # home words of more than one piece meet themselves piece by piece, too
            i, j = near(x, Letters(part.column("word").combine_chunks()))
            if same:
                i, j = i[i < j + at], j[i < j + at]
            i, j = pa.array(i), pa.array(j)
            one, two = a.take(i), part.take(j)
            for p, q in ((one, two), (two, one)):
                yield from pa.table([p.column("word"), q.column("word"), q.column("n")], names=["word", "other", "other_n"]).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        block, piece, at_home = (table.column(c).to_numpy() for c in ("block", "piece", "home"))
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (piece[1:] != piece[:-1]) | (at_home[1:] != at_home[:-1])) + 1
        for i, j in zip([0, *cuts], [*cuts, len(block)], strict=True):
            key, part = (block[i], piece[i]), table.slice(i, j - i).select(["word", "n"])
            if key != last:
                if home:
                    column = pa.concat_tables(home)
                    yield from found(column, column, True)
                last, home, column = key, [], None
            if at_home[i]:
                home.append(part)
            elif home or column is not None:
                if home:
                    column = pa.concat_tables(home).combine_chunks()
                    yield from found(column, column, True)
                    home = []
                yield from found(column, part, False)
    if home:
        column = pa.concat_tables(home)
        yield from found(column, column, True)
    texts.give_back()


def near_words(known: DataFrame, piece: int = PIECE) -> DataFrame:
    """(word, other, other_n): each two words one edit apart, both ways. ``known`` (word, n) has each word once."""
    filed = settled(known.select("word", "n").mapInArrow(_filed, "block long, home boolean, word string, n long"))
    sizes = filed.where("home").groupBy("block").agg(F.ceil(F.count("*") / piece).cast("int").alias("pieces"))
    rows = filed.join(sizes, "block").withColumn("own", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
    # a word at home is at home in its own piece and visits the later ones; a visitor visits all
    to = F.sequence(F.when(F.col("home"), F.col("own")).otherwise(0), F.col("pieces") - 1)
    rows = rows.select("block", "home", "own", "word", "n", F.explode(to).alias("piece"))
    rows = rows.select("block", "piece", (F.col("home") & (F.col("piece") == F.col("own"))).alias("home"), "word", "n")
    dealt = rows.repartition("block", "piece").sortWithinPartitions("block", "piece", F.desc("home"))
    return dealt.mapInArrow(_met, "word string, other string, other_n long")


def roots(forms: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the end of each word's chain of forms, by pointers that double."""
    at = settled(forms.select("word", F.col("form").alias("root")))
    for _ in range(most_rounds):
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = settled(at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = not after.where("moved").isEmpty()
        released(at)
        at = after
        if not moved:
            return at.select("word", "root")
    raise RuntimeError(f"chains of forms have not ended after {most_rounds} rounds")


def variants(docs: DataFrame, times: int = 5, piece: int = PIECE) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word, its near word of most occurrences if it has ``times`` as many, and the chain's end."""
    known = settled(words(docs))
    best = near_words(known, piece).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    form_n = -F.col("best.less")
    rows = known.join(best, "word", "left").withColumn("formed", F.coalesce(form_n >= times * F.col("n"), F.lit(False)))
    rows = settled(rows.select("word", F.when(F.col("formed"), F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("formed"), form_n).alias("form_n")))
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
