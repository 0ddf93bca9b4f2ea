"""Repair of the structure of conversations: a rank-convergence parallel Viterbi over chunks of their rows.

A conversation is repaired by the cheapest edits that give role initials ``(s?(ua)+)?``: keep a row (0), give it
the role that the place asks for (rerole, 2), delete it (3, the only choice for a blank or repeated one), insert an
empty row (2); a truncated row that stays costs 1 more. The state after each row is one of ``START`` (nothing yet),
``OPENED`` (a system row), ``ASKED`` (a user row), ``ANSWERED`` (an assistant row). Costs run backwards: the
vector of a place holds, for each state, the least cost from there to the end.

Conversations are cut into chunks of at most ``CHUNK`` rows, whatever their length, by one range sort, so that no
task holds a conversation. Where a conversation has several chunks, each starts from speculative cost vectors,
one for each state at its end, which any true vector is the least of (shifted by its costs). Where those have come to differ only by constants at the chunk's start, the vector
there is known up to a constant without its successors; where they have not, a fix-up pass joins the chunk with the
one that it leads to and reruns, so that the span doubles with each pass, until all vectors differ only by constants
or have met the conversation's end. Then each chunk runs once more from its true vector (up to a constant) and
traces the edits from each of the four states it may be entered in; the same passes over (state entered, state
left) tell which. Differences within a chunk's vectors are its cost. Of the cheapest edits the ASCII-least string of
initials (D, I, K, R) is traced, one letter at a time.

Rows of a conversation are taken by turn, nulls first, and those of one turn in the order of the SHA-256 of their
role and text. Defined results: a null id, role or text reads as one space (a null id is a conversation of its
own, and comes back null); empty texts are blank; of repeated rows all but the first are duplicates; an empty
table gives an empty result; extra columns are ignored; gaps beyond a long are null.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.shared import released, settled

#: Rows of a chunk, at most.
CHUNK = 4096
START, OPENED, ASKED, ANSWERED = range(4)
#: The state that an inserted or reroled row leads to, by state; and the one that a kept row does, by its initial
#: (0: none of them, 1: s, 2: u, 3: a) and state, -1 where it can't be kept.
FORCED = np.array([ASKED, ASKED, ANSWERED, ASKED])
KEPT = np.array([[-1, -1, -1, -1], [OPENED, -1, -1, -1], [ASKED, ASKED, -1, ASKED], [-1, -1, ANSWERED, -1]])
ROLE = {ASKED: "user", ANSWERED: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Least costs after the last row: (ua)+ may have to be completed by insertions.
AT_END = np.array([0, 2 * INSERT, INSERT, 0], dtype=np.int64)
#: How far apart two costs of one vector can be: of state e (row) and s (column), s costs at most so much more than e, since
#: whoever is in s can do as one in e does, with an insertion, a system row deleted, or (ua) completed at the end.
SPECULATIVE = np.array([[0, 4, 5, 3], [0, 0, 2, 0], [2, 2, 0, 2], [0, 4, 2, 0]], dtype=np.int64)
#: More than any cost of a chunk.
FAR = 1 << 40
NONE, BLANK, DUPLICATE, CUT_OFF = range(4)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) after damage by crc32(`conv_id:turn`) mod 20: 0 drops a row, 1 empties its text, 2 takes its
    full stops, 3 repeats it, 4 makes it the user's."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")), F.lit(20))
    rows = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``row`` (a number), ``mark`` (equal for equal role and text), ``initial`` and ``fault`` (blank and truncated ones); settled."""
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text).withColumn("row", F.monotonically_increasing_id())
    mark = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fault = F.when(blank, BLANK).when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), NONE).otherwise(CUT_OFF)
    return settled(rows.select("*", mark.alias("mark"), initial.alias("initial"), fault.alias("fault")))


def _chunk_batches(batches, size: int):
    """Chunks of rows sorted by conversation: (part, at, conv_id, rows, codes), at most ``size`` rows each; a code is initial + 4 * fault."""
    part, at, held = TaskContext.get().partitionId(), 0, None

    def cut(table: pa.Table, whole: bool):
        nonlocal at
        conv = table.column("conv_id").combine_chunks()
        n = len(conv)
        of = conv.dictionary_encode(null_encoding="encode").indices.to_numpy()
        change = np.flatnonzero(of[1:] != of[:-1]) + 1
        begins = np.concatenate([[0], change])
        counts = np.diff(np.concatenate([begins, [n]]))
        pieces = -(-counts // size)
        first = np.repeat(begins, pieces)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first + nth * size
        end = np.minimum(begin + size, np.repeat(begins + counts, pieces))
        if not whole:  # the last chunk may go on
            begin, end = begin[:-1], end[:-1]
        if len(begin):
            to = pa.array(np.concatenate([begin, end[-1:]]).astype(np.int32))
            columns = [pa.array(np.full(len(begin), part, dtype=np.int32)), pa.array(at + np.arange(len(begin))), conv.take(pa.array(begin)), *(pa.ListArray.from_arrays(to, table.column(c).combine_chunks()) for c in ("row", "code"))]
            at += len(begin)
            yield pa.RecordBatch.from_arrays(columns, names=["part", "at", "conv_id", "rows", "codes"])
        return int(end[-1]) if len(end) else 0

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        done = yield from cut(table, False)
        held = table.slice(done)
    if held is not None and held.num_rows:
        yield from cut(held, True)


def chunks(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """(conv_id, no, last, rows, codes) of ``numbered`` rows: each conversation's chunks, numbered from 0 in order; settled."""
    narrow = rows.select("conv_id", "turn", "mark", "row", "initial", "fault")
    again = narrow.groupBy("conv_id", "mark").agg(F.count("*").alias("n"), F.min(F.struct("turn", "row")).alias("first")).where("n > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("mark").alias("m"), F.col("first.row").alias("first"))
    flagged = narrow.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")), "left")
    fault = F.when((F.col("fault") != BLANK) & (F.col("first") != F.col("row")), DUPLICATE).otherwise(F.col("fault"))
    flagged = flagged.select("conv_id", "turn", "mark", "row", (F.col("initial") + 4 * fault).cast("byte").alias("code"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "mark", "row"]
    dealt = flagged.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "row", "code")
    schema = f"part int, at long, conv_id {dict(rows.dtypes)['conv_id']}, rows array<long>, codes array<byte>"
    cut = settled(dealt.mapInArrow(partial(_chunk_batches, size=size), schema))
    # only a partition's first conversation can go on from earlier ones: at most one offset for each partition
    counted = cut.groupBy("part", "conv_id").agg(F.count("*").alias("n"), F.min("at").alias("begin"))
    heads = counted.where("begin = 0").select(F.col("part").alias("p"), F.col("conv_id").alias("c"))
    carried = counted.join(heads, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") < F.col("p"))).groupBy("p", "c").agg(F.sum("n").alias("carried"))
    # and a chunk is its conversation's last one if that has no more in its partition and begins no later one
    ends = counted.groupBy("conv_id").agg(F.max("part").alias("end")).select(F.col("conv_id").alias("e"), "end")
    own = counted.select(F.col("part").alias("q"), F.col("conv_id").alias("o"), "n", "begin")
    cut = cut.join(own, (F.col("part") == F.col("q")) & F.col("conv_id").eqNullSafe(F.col("o")))
    cut = cut.join(carried, (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")), "left").join(ends, F.col("conv_id").eqNullSafe(F.col("e")))
    last = (F.col("part") == F.col("end")) & (F.col("at") == F.col("begin") + F.col("n") - 1)
    return settled(cut.select("conv_id", (F.col("at") - F.col("begin") + F.coalesce("carried", F.lit(0))).alias("no"), last.alias("last"), "rows", "codes"))


def closed(costs: np.ndarray) -> np.ndarray:
    """Cost vectors (last axis: states) after insertions where those are cheaper."""
    out = costs.copy()
    out[..., ASKED] = np.minimum(costs[..., ASKED], INSERT + costs[..., ANSWERED])
    out[..., ANSWERED] = np.minimum(costs[..., ANSWERED], INSERT + costs[..., ASKED])
    for s in (START, OPENED):
        out[..., s] = np.minimum(costs[..., s], INSERT + out[..., ASKED])
    return out


def _choices(codes: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of deleting, keeping and reroling rows (n,) in each state, given the vectors (n, ..., 4) behind them."""
    extra = (slice(None),) + (None,) * (after.ndim - 1)
    initial, fault = codes & 3, codes >> 2
    stays = np.where((fault == BLANK) | (fault == DUPLICATE), FAR, TRUNCATED * (fault == CUT_OFF))[extra]
    to = KEPT[initial].reshape(len(codes), *(1,) * (after.ndim - 2), 4)
    kept = np.where(to < 0, FAR, np.take_along_axis(after, np.broadcast_to(np.maximum(to, 0), after.shape), axis=-1))
    return DELETE + after, stays + kept, stays + REROLE + after[..., FORCED]


def backward(codes: list[np.ndarray], ends: np.ndarray, keep: bool) -> np.ndarray:
    """Cost vectors of chunks, from those at their ends (m, ..., 4): at their starts, or of all places (m, longest + 1, ..., 4), ends aligned right."""
    m, lengths = len(codes), np.array([len(c) for c in codes], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max()) if m else 0
    now = ends[order].astype(np.int64)
    padded = np.zeros((m, longest), dtype=np.int64)
    for i, k in enumerate(order):
        padded[i, longest - lengths[k] :] = codes[k]
    places = [now] if keep else []
    for step in range(1, longest + 1):
        active = int(np.searchsorted(-lengths[order], -step, side="right"))
        now = now.copy() if keep else now
        now[:active] = closed(np.minimum.reduce(_choices(padded[:active, longest - step], now[:active])))
        if keep:
            places.append(now)
    back = np.argsort(order, kind="stable")
    return np.stack(places[::-1], axis=1)[back] if keep else now[back]


def trace(codes: list[np.ndarray], ends: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """For each chunk and each state it is entered in: the state left, the cost, and the ASCII-least of the cheapest edits."""
    m, lengths = len(codes), np.array([len(c) for c in codes], dtype=np.int64)
    longest = int(lengths.max()) if m else 0
    costs = backward(codes, ends, keep=True)
    padded = np.zeros((m, longest + 1), dtype=np.int64)
    for i, c in enumerate(codes):
        padded[i, longest - len(c) : longest] = c
    place = np.repeat(longest - lengths, 4)  # of each trace: chunk by chunk, state by state
    state = np.tile(np.arange(4), m)
    chunk = np.repeat(np.arange(m), 4)
    written = []
    going = np.arange(4 * m)
    while len(going):
        i, p, s = chunk[going], place[going], state[going]
        over = (p == longest) & (~last[i] | (s == START) | (s == ANSWERED))
        going, i, p, s = going[~over], i[~over], p[~over], s[~over]
        if not len(going):
            break
        here = costs[i, p, s]
        inside = p < longest
        behind = costs[i, np.minimum(p + 1, longest)]
        each = [c[np.arange(len(s)), s] for c in _choices(padded[i, np.minimum(p, longest)], behind)]
        delete, keep = inside & (each[0] == here), inside & (each[1] == here)
        insert = INSERT + costs[i, p, FORCED[s]] == here
        letter = np.where(delete, ord("D"), np.where(insert, ord("I"), np.where(keep, ord("K"), ord("R")))).astype(np.uint8)
        to_kept = KEPT[padded[i, np.minimum(p, longest)] & 3, s]
        state[going] = np.where(letter == ord("D"), s, np.where(letter == ord("K"), to_kept, FORCED[s]))
        place[going] = p + (letter != ord("I"))
        written.append((going, letter))
    who = np.concatenate([g for g, _ in written]) if written else np.zeros(0, np.int64)
    letters = np.concatenate([x for _, x in written]) if written else np.zeros(0, np.uint8)
    letters = letters[np.argsort(who, kind="stable")].tobytes().decode()
    to = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=4 * m))])
    audits = [letters[a:b] for a, b in zip(to[:-1], to[1:], strict=True)]
    state = state.reshape(m, 4)
    spent = costs[np.arange(m), longest - lengths] - np.take_along_axis(costs[:, -1], state, axis=1)
    return state, spent, [audits[4 * i : 4 * i + 4] for i in range(m)]


def _codes(batch: pa.RecordBatch) -> list[np.ndarray]:
    column = batch.column("codes")
    values, to = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b].astype(np.int64) for a, b in zip(to[:-1], to[1:], strict=True)]


def _lists(rows: np.ndarray) -> pa.Array:
    rows = rows.reshape(len(rows), -1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.reshape(-1).astype(np.int64)))


#: Cells of cost vectors that are held at a time.
HELD = 1 << 21


def _few(batch: pa.RecordBatch):
    """Parts of a batch of chunks whose cost vectors are no more than ``HELD`` cells."""
    at = 0
    lengths = np.diff(batch.column("codes").offsets.to_numpy())
    while at < batch.num_rows:
        longest = np.maximum.accumulate(lengths[at:]) + 1
        n = max(1, int(np.searchsorted(longest * np.arange(1, len(longest) + 1) * 16, HELD, side="right")))
        yield pa.RecordBatch.from_arrays([c.take(pa.array(np.arange(at, min(at + n, batch.num_rows)))) for c in batch.columns], names=batch.schema.names)
        at += n


def _speculative_batches(batches):
    """The vectors at each chunk's start, for each of the speculative ones at its end."""
    for batch in batches:
        for part in _few(batch):
            codes = _codes(part)
            found = backward(codes, np.broadcast_to(SPECULATIVE, (len(codes), 4, 4)), keep=False)
            yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("no"), _lists(found)], names=["conv_id", "no", "reach"])


def _parallel(reach: np.ndarray) -> np.ndarray:
    """Whether vectors (..., 4 ends, 4 states) differ only by constants."""
    level = reach - reach[..., :1]
    return (level == level[..., :1, :]).all(axis=(-1, -2))


def _joined_batches(batches):
    """One fix-up pass: ``reach`` of a chunk and the ``beyond`` of the one it leads to, as the reach of both."""
    for batch in batches:
        reach, beyond = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4, 4) for c in ("reach", "beyond"))
        both = (beyond[:, :, :, None] + reach[:, None, :, :]).min(axis=2)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("no"), batch.column("next"), _lists(both), pa.array(_parallel(both))], names=["conv_id", "no", "next", "reach", "known"])


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _doubled(state: DataFrame, step, most_rounds: int = 64) -> DataFrame:
    """Fix-up passes over ``state`` (conv_id, no, next, known, ...): ``step`` joins a row that is not known with the one at ``next``."""
    for _ in range(most_rounds):
        if state.where("NOT known").isEmpty():
            return state
        after = settled(state.where("known").unionByName(step(state.where("NOT known"), state)))
        released(state)
        state = after
    raise RuntimeError(f"vectors have not settled after {most_rounds} passes")


def end_vectors(cut: DataFrame) -> DataFrame:
    """(conv_id, no, ends): for each chunk that is not its conversation's last one the cost vector at its end, up to a constant; settled."""
    kind = dict(cut.dtypes)["conv_id"]
    some = cut.where("NOT last OR no > 0")
    guessed = some.select("conv_id", "no", "codes").mapInArrow(_speculative_batches, f"conv_id {kind}, no long, reach array<long>")
    guessed = guessed.join(some.where("last").select(F.col("conv_id").alias("c"), F.col("no").alias("l")), _same("conv_id", "c") & (F.col("no") == F.col("l")), "left")
    # the last chunk's end is no guess: whatever state it would be left in, the cost from there is known
    ended = F.col("l").isNotNull()
    own = lambda s: F.array_min(F.array(*[F.element_at("reach", 4 * e + s + 1) + int(AT_END[e]) for e in range(4)]))
    reach = F.when(ended, F.flatten(F.array_repeat(F.array(*[own(s) for s in range(4)]), 4))).otherwise(F.col("reach"))
    row = lambda e: F.transform(F.slice("reach", 4 * e + 1, 4), lambda x: x - F.element_at("reach", 4 * e + 1))
    known = (row(0) == row(1)) & (row(0) == row(2)) & (row(0) == row(3))
    state = guessed.select("conv_id", "no", (F.col("no") + 1).alias("next"), reach.alias("reach")).withColumn("known", known)
    state = settled(state)

    def step(open_: DataFrame, every: DataFrame) -> DataFrame:
        ahead = every.select(F.col("conv_id").alias("c"), F.col("no").alias("n"), F.col("next").alias("onward"), F.col("reach").alias("beyond"))
        met = open_.join(ahead, _same("conv_id", "c") & (F.col("next") == F.col("n"))).select("conv_id", "no", F.col("onward").alias("next"), "reach", "beyond")
        return met.mapInArrow(_joined_batches, f"conv_id {kind}, no long, next long, reach array<long>, known boolean")

    state = _doubled(state, step)
    return settled(state.where("no > 0").select("conv_id", (F.col("no") - 1).alias("no"), F.slice("reach", 1, 4).alias("ends")))


def _trace_batches(batches):
    for batch in batches:
        for part in _few(batch):
            codes, last = _codes(part), part.column("last").to_numpy(zero_copy_only=False)
            ends = np.array([AT_END if x is None else x for x in part.column("ends").to_pylist()], dtype=np.int64).reshape(-1, 4)
            left, spent, audits = trace(codes, ends, last)
            columns = [part.column("conv_id"), part.column("no"), pa.array(last), part.column("rows"), part.column("codes"), _lists(left), _lists(spent), pa.array(audits, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "no", "last", "rows", "codes", "left", "costs", "audits"])


def edits(cut: DataFrame) -> DataFrame:
    """(conv_id, no, entered, cost, audit, rows, codes): the edits of each chunk of ``chunks``; settled."""
    kind = dict(cut.dtypes)["conv_id"]
    ends = end_vectors(cut).select(F.col("conv_id").alias("c"), F.col("no").alias("n"), "ends")
    traced = cut.join(ends, _same("conv_id", "c") & (F.col("no") == F.col("n")), "left").select("conv_id", "no", "last", "rows", "codes", "ends")
    traced = settled(traced.mapInArrow(_trace_batches, f"conv_id {kind}, no long, last boolean, rows array<long>, codes array<byte>, left array<long>, costs array<long>, audits array<string>"))

    # the state that a chunk is left in: known where all states entered lead to one, or the conversation begins
    left = F.when(F.col("no") == 0, F.array_repeat(F.element_at("left", START + 1), 4)).otherwise(F.col("left"))
    one = F.array_min("left") == F.array_max("left")
    state = traced.where("NOT last OR no > 0").select("conv_id", "no", (F.col("no") - 1).alias("next"), left.alias("left")).withColumn("known", one)

    def step(open_: DataFrame, every: DataFrame) -> DataFrame:
        back = every.select(F.col("conv_id").alias("c"), F.col("no").alias("n"), F.col("next").alias("onward"), F.col("left").alias("before"))
        met = open_.join(back, _same("conv_id", "c") & (F.col("next") == F.col("n")))
        both = F.transform("before", lambda s: F.element_at("left", (s + 1).cast("int")))
        return met.select("conv_id", "no", F.col("onward").alias("next"), both.alias("left")).withColumn("known", one)

    entered = _doubled(settled(state), step).select(F.col("conv_id").alias("c"), (F.col("no") + 1).alias("n"), F.element_at("left", 1).alias("entered"))
    traced = traced.join(entered, _same("conv_id", "c") & (F.col("no") == F.col("n")), "left").withColumn("entered", F.coalesce("entered", F.lit(START)).cast("int"))
    at = F.col("entered") + 1
    return settled(traced.select("conv_id", "no", "entered", F.element_at("costs", at).alias("cost"), F.element_at("audits", at).alias("audit"), "rows", "codes"))


def _plan_batches(batches):
    """The repaired rows of each chunk: which row is kept, and under which role (null: its own)."""
    for batch in batches:
        conv, no, at, row, role = [], [], [], [], []
        for c, k, state, audit, rows, codes in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "no", "entered", "audit", "rows", "codes")), strict=True):
            i = 0
            for place, letter in enumerate(audit):
                own = None
                if letter != "I":
                    own, i = rows[i], i + 1
                if letter == "D":
                    continue
                state = int(KEPT[codes[i - 1] & 3, state] if letter == "K" else FORCED[state])
                conv.append(c)
                no.append(k)
                at.append(place)
                row.append(own)
                role.append(None if letter == "K" else ROLE[state])
        columns = [pa.array(conv, batch.schema.field("conv_id").type), *(pa.array(x, pa.int64()) for x in (no, at, row)), pa.array(role, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "no", "at", "row", "role"])


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, no, at, role, text): the repaired conversations, in the order of ``no`` and ``at``, from ``numbered`` rows and their ``edits``."""
    kind = dict(found.dtypes)["conv_id"]
    plan = found.select("conv_id", "no", "entered", "audit", "rows", "codes").mapInArrow(_plan_batches, f"conv_id {kind}, no long, at long, row long, role string")
    own = rows.select(F.col("row").alias("of"), F.col("role").alias("said"), "text")
    return plan.join(own, F.col("row") == F.col("of"), "left").select("conv_id", "no", "at", F.coalesce("role", "said").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _digest_batches(batches):
    last, digest, any_ = None, None, False
    for batch in batches:
        out = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if not any_ or conv != last:
                if any_:
                    out.append((last, digest.hexdigest()))
                last, digest, any_ = conv, hashlib.sha256(), True
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        kind = batch.schema.field("conv_id").type
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], kind), pa.array([x for _, x in out], pa.string())], names=["conv_id", "sha256"])
    if any_:
        yield pa.RecordBatch.from_arrays([pa.array([last], kind), pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "sha256"])


def digests(fixed: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's `role:text` rows, joined by line ends.

    A digest is one chain over its bytes: a conversation's rows stream through one task, sorted with spill, and only the
    hash's state is held.
    """
    kind = dict(fixed.dtypes)["conv_id"]
    dealt = fixed.repartition("conv_id").sortWithinPartitions("conv_id", "no", "at").select("conv_id", "role", "text")
    return dealt.mapInArrow(_digest_batches, f"conv_id {kind}, sha256 string")


def _with_fault(kind: int):
    return lambda code: F.shiftright(code.cast("int"), 2) == kind


def report(conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row for each conversation of ``conversations``: faults after damage, and the repair's cost, audit and digest."""
    rows = numbered(damaged(conversations))
    found = edits(chunks(rows, size))
    counts = found.select("conv_id", "no", "cost", "audit", "codes", *[F.size(F.filter("codes", _with_fault(k))).alias(name) for k, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT_OFF, "truncated"))])
    initial = lambda c: c.cast("int").bitwiseAND(F.lit(3))
    right = lambda a, b: ((b == 2) & ((a == 1) | (a == 3))) | ((a == 2) & (b == 3))
    pairs = F.zip_with(F.slice("codes", F.lit(1), F.size("codes") - 1), F.slice("codes", F.lit(2), F.size("codes") - 1), lambda a, b: ~right(initial(a), initial(b)))
    counts = counts.withColumn("illegal", F.size(F.filter(pairs, lambda x: x)))
    # and between two chunks: the last row of one and the first of the next
    edge = counts.select(F.col("conv_id").alias("c"), (F.col("no") + 1).alias("n"), initial(F.element_at("codes", -1)).alias("before"))
    counts = counts.join(edge, _same("conv_id", "c") & (F.col("no") == F.col("n")), "left")
    counts = counts.withColumn("illegal", F.col("illegal") + F.when(F.col("before").isNotNull() & ~right(F.col("before"), initial(F.element_at("codes", 1))), 1).otherwise(0))
    parts = F.array_sort(F.collect_list(F.struct("no", "audit")))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    summed = counts.groupBy("conv_id").agg(*sums, F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
    turns = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("n"))
    width = F.col("high").cast("decimal(38,0)") - F.col("low").cast("decimal(38,0)") + 1 - F.col("n")
    gaps = turns.select("conv_id", F.when(F.col("low").isNull(), F.lit(0).cast("long")).otherwise(width.try_cast("long")).alias("gaps"))
    out = conversations.select("conv_id").distinct()
    for i, (more, column) in enumerate(((summed, "blank"), (gaps, "gaps"), (digests(repaired(rows, found)), "sha256"))):
        out = out.join(more.withColumnRenamed("conv_id", f"c{i}"), _same("conv_id", f"c{i}"), "left")
        if column == "gaps":
            out = out.withColumn("gaps", F.when(F.col("blank").isNull(), 0).otherwise(F.col("gaps")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", "gaps", *[zero(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
