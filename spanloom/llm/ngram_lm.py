"""An n-gram language model in an Elias-Fano trie, built in shards and memory-mapped by the tasks that score.

Levels: words (sorted 64-bit hashes), pairs and triples. A level holds, for each context, the words that
follow it, as positions among the words that follow the context's last word (for pairs: among all words).
Contexts, the pointers to their first successors, and the successors are monotone sequences in Elias-Fano
form; successors are made monotone by starting each context above the last value of the one before. A
lookup finds the context, takes the value before its first successor as base, and searches base plus
position. Probabilities and back-off weights are quantised logarithms.

Counts cover all training texts, and every pair and triple that occurs has an entry. Words are counted first and the texts
written once as word ids; the later passes read these. A shard is a range of contexts, whose order follows hashes of words. A task
counts its own slice of ids and sends each shard one row with its sorted codes; the task of a shard merges what
it gets, a few rows at a time, and writes the shard as a file to the shared folder; the driver sees one
row per shard. Smoothing is interpolated absolute discounting; what the words' discounts leave is the
probability of an unknown word.

Defined results: a null text counts as empty; an empty text is one end token; texts are scored whole,
however long; repeated rows get equal scores and count twice in training; extra columns are ignored; with
nothing to learn from every token has probability 1; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm import texts
from spanloom.llm.shared import crc_remainder, released, settled, shared_folder, shuffles_dropped

DISCOUNT = 0.75
#: The most that the words' own discount, which is taken from their counts, comes to.
MOST_DISCOUNT = 0.9
#: Training tokens per shard of a level, ids that are counted or scored at once, and codes that are merged at once.
SHARD_TOKENS, SLICE_TOKENS, MERGE = 1 << 21, 1 << 19, 1 << 21
#: Step and number of the quantised logarithms (base 10).
STEP, LEVELS = 12 / 4095, 4096
#: Bits of a position in a packed (context, position): 2^30 words, 2^33 contexts; beyond, fitting raises.
PLACES = 30
_PLACE = (1 << PLACES) - 1
_FLIP = np.uint64(1 << 63)
_END = np.uint64(0x5D7E1F0C3A9B2468)
ONE = np.uint64(1)
_BYTES, _HIGHS, _FIVES, _THREES, _NIBBLES = (np.uint64(x * 0x0101010101010101) for x in (1, 0x80, 0x55, 0x33, 0x0F))
# place of the set bit of rank r in byte b, at 8 b + r
_SELECT = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for b in range(256) for r in range(8)], dtype=np.int64)


class EliasFano:
    """A monotone sequence of unsigned 64-bit numbers: low bits packed, high bits in unary."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits = (int(x) for x in arrays["shape"])
        self.low, self.high, self.ones = arrays["low"], arrays["high"], arrays["ones"]
        self.zeros = arrays["zeros"]

    @staticmethod
    def build(values: np.ndarray) -> dict[str, np.ndarray]:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = np.zeros((n * low_bits + 63) // 64 + 1, dtype=np.uint64)
        if low_bits:
            at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            part = values & np.uint64((1 << low_bits) - 1)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(low_bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(place[-1]) + 2 if n else 1) + 63 & ~63, dtype=np.uint8)
        bits[place] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)]).astype(np.uint32 if n < 2**32 else np.int64)
        zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones
        return {"shape": np.array([n, low_bits]), "low": low, "high": high, "ones": ones, "zeros": zeros.astype(np.uint32 if len(bits) < 2**32 else np.int64)}

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> shift
        far = self.low[word + 1] << ONE << (np.uint64(63) - shift)  # nothing where the shift is 0
        return (value | far) & np.uint64((1 << self.low_bits) - 1)

    @staticmethod
    def _in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Place of the set bit of that rank in each word: its byte by sums over bytes, then a table."""
        own = word - ((word >> ONE) & _FIVES)
        own = (own & _THREES) + ((own >> np.uint64(2)) & _THREES)
        upto = ((own + (own >> np.uint64(4))) & _NIBBLES) * _BYTES  # byte k: set bits up to and with byte k
        wanted = rank.astype(np.uint64)
        # a byte's high bit stays where its sum is above the rank
        below = ((upto | _HIGHS) - (wanted * _BYTES + _BYTES)) & _HIGHS
        byte = np.uint64(8) - np.bitwise_count(below).astype(np.uint64)
        before = ((upto << np.uint64(8)) >> (byte << np.uint64(3))) & np.uint64(255)
        held = (word >> (byte << np.uint64(3))) & np.uint64(255)
        return (byte << np.uint64(3)).astype(np.int64) + _SELECT[(held << np.uint64(3) | (wanted - before)).astype(np.int64)]

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), side="right") - 1
        place = word * 64 + self._in_word(self.high[word], i - self.ones[word].astype(np.int64))
        return ((place - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(i)

    def at_and_after(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at positions ``i`` and at those after them."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), side="right") - 1
        held = self.high[word]
        bit = self._in_word(held, i - self.ones[word].astype(np.int64))
        rest = held & (~np.uint64(1) << bit.astype(np.uint64))  # the ones above
        after = word * 64 + np.bitwise_count((rest & (~rest + ONE)) - ONE)
        far = np.flatnonzero(rest == 0)
        if len(far):
            next_word = np.searchsorted(self.ones, (i[far] + 1).astype(self.ones.dtype), side="right") - 1
            after[far] = next_word * 64 + self._in_word(self.high[next_word], i[far] + 1 - self.ones[next_word].astype(np.int64))
        shift = np.uint64(self.low_bits)
        return ((word * 64 + bit - i).astype(np.uint64) << shift) | self._lows(i), ((after - i - 1).astype(np.uint64) << shift) | self._lows(i + 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the ``k``-th zero of the high bits."""
        word = np.minimum(np.searchsorted(self.zeros, k.astype(self.zeros.dtype), side="right") - 1, len(self.high) - 1)
        return word * 64 + self._in_word(~self.high[word], k - self.zeros[word])

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The position of the first element that is not below each value (the length where there is none), and
        whether it equals the value."""
        exact = np.zeros(len(values), dtype=bool)
        if not self.n:
            return np.zeros(len(values), dtype=np.int64), exact
        high = values >> np.uint64(self.low_bits)
        low = values & np.uint64((1 << self.low_bits) - 1)
        last = len(self.high) * 64 - int(self.ones[-1]) - 1
        beyond = high > np.uint64(last)
        high = np.minimum(high, np.uint64(last)).astype(np.int64)
        place = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) + 1, 0)
        start = place - high
        # a bucket is a run of ones, which mostly ends in the word where it begins
        rest = ~self.high[place >> 6] >> (place & 63).astype(np.uint64)
        stop = start + np.bitwise_count((rest & (~rest + ONE)) - ONE)
        far = np.flatnonzero(rest == 0)
        if len(far):
            stop[far] = self._zero(high[far]) - high[far]
        # a context with many successors fills a bucket densely, so its low bits are searched by halves
        active = np.flatnonzero((start < stop) & ~beyond)
        begin, end, sought = start[active], stop[active], low[active]
        same = np.zeros(len(active), dtype=bool)  # whether the element at the end equals the value
        while len(active):
            middle = (begin + end) >> 1
            held = self._lows(middle)
            less = held < sought
            begin, end, same = np.where(less, middle + 1, begin), np.where(less, end, middle), np.where(less, same, held == sought)
            start[active], exact[active] = begin, same
            more = np.flatnonzero(begin < end)
            active, begin, end, sought, same = (x.take(more) for x in (active, begin, end, sought, same))
        return np.where(beyond, self.n, start), exact


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: a header, then the arrays, each on a boundary of 64 bytes. Whole or not at all."""
    head, at = {}, 0
    for name, x in arrays.items():
        head[name] = (str(x.dtype), len(x), at)
        at += -(-x.nbytes // 64) * 64
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    system, place = _system(path)
    rough = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(rough) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for x in arrays.values():
            out.write(pa.py_buffer(np.ascontiguousarray(x)))
            out.write(b"\0" * (-x.nbytes % 64))
    system.move(rough, place)


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def load(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped; a file in a remote store is copied to a local one that has no name."""
    from pyarrow import fs

    system, place = _system(path)
    if isinstance(system, fs.LocalFileSystem):
        raw = np.asarray(np.memmap(place, dtype=np.uint8, mode="r"))
    else:
        with tempfile.TemporaryFile() as own:
            with system.open_input_stream(place) as source:
                while piece := source.read(1 << 24):
                    own.write(piece)
            own.flush()
            raw = np.asarray(np.memmap(own, dtype=np.uint8, mode="r"))
    size = int.from_bytes(raw[:8].tobytes(), "little")
    base = 8 + size
    return {name: raw[base + at : base + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, n, at) in json.loads(raw[8:base].tobytes()).items()}


def _quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-log10 / STEP), 0, LEVELS - 1).astype(np.uint16)


class Steps:
    """Quantised logarithms in twelve bits each: a byte, and half of one that two share."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high

    @staticmethod
    def build(name: str, steps: np.ndarray) -> dict[str, np.ndarray]:
        high = (steps >> 8).astype(np.uint8)
        high = np.append(high, np.zeros(len(high) % 2, np.uint8))
        return {f"{name}.low": steps.astype(np.uint8), f"{name}.high": high[::2] | (high[1::2] << 4)}

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self.high[i >> 1] >> ((i & 1) << 2).astype(np.uint8) & np.uint8(15)).astype(np.int64) << 8 | self.low[i]


class Level:
    """One level of the trie over all its shards, which are ranges of contexts."""

    def __init__(self, shards: list[tuple[int, int, str]]):
        """``shards``: (first context, entries, path), in order."""
        self.first = np.array([s[0] % 2**64 for s in shards], dtype=np.uint64)
        self.base = np.concatenate([[0], np.cumsum([s[1] for s in shards], dtype=np.int64)])
        self.paths, self.open = [s[2] for s in shards], {}

    def shard(self, i: int) -> dict:
        if i not in self.open:
            a = load(self.paths[i])
            part = lambda p: EliasFano({k[len(p) :]: v for k, v in a.items() if k.startswith(p)})
            self.open[i] = {"contexts": part("contexts."), "pointers": part("pointers."), "successors": part("successors."), **{k: Steps(a[f"{k}.low"], a[f"{k}.high"]) for k in ("log", "back")}, **{k: a[k] for k in ("count",) if k in a}}
        return self.open[i]

    def runs(self, bounds: np.ndarray):
        """Shards with entries, and the slice of sorted things that ``bounds`` gives each."""
        for i in range(len(self.paths)):
            if bounds[i] < bounds[i + 1] and self.base[i] < self.base[i + 1]:
                yield i, slice(bounds[i], bounds[i + 1])

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each of sorted hashes, or -1: in the first level all words follow the empty context."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        for i, own in self.runs(np.append(np.searchsorted(hashes, self.first), len(hashes))):
            at, good = self.shard(i)["successors"].find(hashes[own])
            out[own] = np.where(good, at + self.base[i], -1)
        return out

    def find(self, context: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each (context, position), sorted: the entry, its quantised logarithm, the context's first entry and its
        quantised back-off weight; entries that there aren't are -1.

        A search relative to the context: its pointer gives its first and last successor, the value before the
        first one is the base, and base plus position is searched among the successors.
        """
        n = len(context)
        entry, start = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        log, back = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        if not n:
            return entry, log, start, back
        for i, rows in self.runs(np.append(np.searchsorted(context, self.first.astype(np.int64)), n)):
            s, mine = self.shard(i), context[rows]
            fresh = np.concatenate([[True], mine[1:] != mine[:-1]])
            at, here = s["contexts"].find(mine[fresh].astype(np.uint64))
            known = np.flatnonzero(here)
            if not len(known):
                continue
            first, last, base = (np.full(len(here), -1, dtype=np.int64) for _ in range(3))
            first[known], last[known] = (x.astype(np.int64) for x in s["pointers"].at_and_after(at[known]))
            base[known] = np.where(first[known] > 0, s["successors"].at(np.maximum(first[known] - 1, 0)).astype(np.int64) + 1, 0)
            weight = np.zeros(len(here), dtype=np.int64)
            weight[known] = s["back"][at[known]]
            group = np.cumsum(fresh) - 1
            begin = first[group]
            start[rows] = np.where(begin >= 0, begin + self.base[i], -1)
            back[rows] = weight[group]
            sought = position[rows]
            at, good = s["successors"].find((base[group] + np.maximum(sought, 0)).astype(np.uint64))
            good &= (begin >= 0) & (sought >= 0) & (at < last[group])
            entry[rows] = np.where(good, at + self.base[i], -1)
            log[rows] = np.where(good, s["log"][np.where(good, at, 0)], 0)
        return entry, log, start, back

    def values(self, entry: np.ndarray, name: str) -> np.ndarray:
        """A value of each of sorted entries."""
        out = np.zeros(len(entry), dtype=np.int64)
        for i, own in self.runs(np.append(np.searchsorted(entry, self.base[:-1]), len(entry))):
            out[own] = self.shard(i)[name][entry[own] - self.base[i]]
        return out


class Model:
    """What tasks need of the model: totals and the levels' shards."""

    def __init__(self, total: int, distinct: int, unknown: float, levels: list[list]):
        self.total, self.distinct, self.unknown = total, distinct, unknown
        self.levels = [Level(shards) for shards in levels]


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts with the end tokens, and each text's first, with the end."""
    data, offsets = texts.flat(part.column("text"))
    data = texts.LOWER[data] if len(data) else data
    starts, ends, firsts = texts.word_bounds(data, offsets)
    hashes = texts.word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return np.insert(hashes, firsts[1:], _END), firsts + np.arange(len(firsts))


def _rows(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64) if c.dtype != np.uint64 else c.view(np.int64)) for c in columns], names=names)


def _word_counts(batches):
    for batch in batches:
        for part in texts.slices(batch, limit=3 << 20):
            word, n = np.unique(_tokens(part)[0], return_counts=True)
            yield _rows(["word", "n"], word ^ _FLIP, n)  # signed order is then the unsigned one


def _per_text(x: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums over each text's tokens, alike for equal texts wherever they stand; every text has a token."""
    return np.add.reduceat(x, firsts[:-1])


def _id_batches(batches, model):
    """Each text as word ids, -1 where a word is not known; with its known tokens and base score."""
    held = Model(*model.value)
    for batch in batches:
        for part in texts.slices(batch, limit=3 << 20):
            hashes, firsts = _tokens(part)
            unique, back = np.unique(hashes, return_inverse=True)
            ids = held.levels[0].words(unique) if held.levels else np.full(len(unique), -1)
            count, known = np.zeros(len(ids)), ids >= 0
            if known.any():
                count[known] = held.levels[0].values(ids[known], "count")
            base = np.log10((count + 1) / (held.total + held.distinct + 1))
            lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(ids.astype(np.int32)[back]))
            columns = [part.column("doc_id"), part.column("held_out"), pa.array(_per_text(known.astype(np.int64)[back], firsts)), pa.array(_per_text(base[back], firsts)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_known", "base_score", "ids"])


def _slices(batch: pa.RecordBatch, tokens: int = SLICE_TOKENS):
    """Parts of a batch of ids of about so many tokens; one text is never cut."""
    ends = batch.column("ids").offsets.to_numpy()
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + tokens, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    texts.give_back()


class Positions:
    """The tokens of a slice as word ids, and the entries of the pairs and triples that end at each."""

    def __init__(self, part: pa.RecordBatch):
        lists = part.column("ids")
        ends = lists.offsets.to_numpy()
        self.firsts = ends.astype(np.int64) - int(ends[0])
        self.ids = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(np.int64)
        inner = np.ones(len(self.ids), dtype=bool)
        inner[self.firsts[:-1]] = False
        self.context = np.where(inner, np.concatenate([[-1], self.ids[:-1]]), -1)

    def look_up_pairs(self, model: Model) -> None:
        n, some = len(self.ids), np.flatnonzero(self.context >= 0)
        # every context and word once and in order, also those whose word is not known (-1)
        code, which = np.unique(self.context[some] << PLACES | (self.ids[some] + 1), return_inverse=True)
        found = model.levels[1].find(code >> PLACES, (code & _PLACE) - 1)
        self.pair, self.pair_log, self.pair_start, self.pair_back = (np.full(n, x, dtype=np.int64) for x in (-1, 0, -1, 0))
        for whole, own in zip((self.pair, self.pair_log, self.pair_start, self.pair_back), found, strict=True):
            whole[some] = own[which]
        # position of a pair's word among its context's successors
        self.position = np.where(self.pair >= 0, self.pair - self.pair_start, -1)
        last = np.concatenate([[-1], self.pair[:-1]])
        last[self.firsts[:-1]] = -1
        self.long_context = last


def _planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then their second bytes and so on, as those that are mostly zero shuffle small."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _zipped(raw: bytes) -> bytes:
    """Its length and itself by zstandard, which codes bytes by how often they come, as the shuffle's own compression does not."""
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unzipped(held: bytes) -> bytes:
    return pa.Codec("zstd").decompress(memoryview(held)[8:], int.from_bytes(held[:8], "little"), asbytes=True)


def _unplanes(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, -1).T).view(kind).ravel()


def _packed(codes: np.ndarray) -> bytes:
    """Sorted codes as the first context, the steps to the next ones, and positions."""
    context = codes >> PLACES
    steps = np.diff(context, prepend=context[:1])
    kind = np.uint32 if int(steps.max()) < 2**32 else np.uint64
    return context[:1].tobytes() + _planes(steps.astype(kind)) + _planes((codes & _PLACE).astype(np.uint32))


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    size = len(raw) - 8 - 4 * n
    steps = _unplanes(raw[8 : 8 + size], np.uint32 if size == 4 * n else np.uint64).astype(np.int64)
    context = np.cumsum(steps) + np.frombuffer(raw, dtype=np.int64, count=1)[0]
    return context << PLACES | _unplanes(raw[8 + size :], np.uint32)


def _counted(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes in order, how often each is there, and a place of each."""
    order = np.argsort(code)
    code = code[order]
    begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[begin], np.diff(np.append(begin, len(code))), order[begin]


def _blocks(code: np.ndarray, n: np.ndarray, below: np.ndarray, firsts: np.ndarray) -> pa.RecordBatch:
    """One row for each shard, of those that begin with the contexts ``firsts``: its codes (context and position) in
    order, their counts, and the quantised logarithms of what they back off to."""
    bounds = np.append(np.searchsorted(code >> PLACES, firsts), len(code))
    cuts = [(i, slice(bounds[i], bounds[i + 1])) for i in np.flatnonzero(bounds[:-1] < bounds[1:])]
    columns = [pa.array([_zipped(pack(x[own])) for _, own in cuts], pa.binary()) for x, pack in ((code, _packed), (n.astype(np.uint32), _planes), (below.astype(np.uint16), _planes))]
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in cuts], pa.int32()), *columns], names=["shard", "codes", "counts", "below"])


def _pair_counts(batches, firsts: np.ndarray, model):
    held = Model(*model.value)
    for batch in batches:
        for part in _slices(batch, 4 * SLICE_TOKENS):  # the more at once, the fewer pairs twice
            p = Positions(part)
            good = (p.context >= 0) & (p.ids >= 0)
            code, n, _ = _counted(p.context[good] << PLACES | p.ids[good])
            word, back = np.unique(code & _PLACE, return_inverse=True)
            yield _blocks(code, n, held.levels[0].values(word, "log")[back], firsts)


def _triple_counts(batches, firsts: np.ndarray, model):
    held = Model(*model.value)
    for batch in batches:
        for part in _slices(batch):
            p = Positions(part)
            p.look_up_pairs(held)
            good = np.flatnonzero((p.long_context >= 0) & (p.pair >= 0))
            code, n, at = _counted(p.long_context[good] << PLACES | p.position[good])
            yield _blocks(code, n, p.pair_log[good[at]], firsts)


def _added(codes: list[np.ndarray], counts: list[np.ndarray], below: list[np.ndarray]) -> list[np.ndarray]:
    """Distinct codes in order, with the sums of their counts, and what is below them."""
    code = np.concatenate(codes)
    order = np.argsort(code)
    code, n, lower = code[order], np.concatenate(counts).astype(np.int64)[order], np.concatenate(below)[order]
    begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return [code[begin], np.add.reduceat(n, begin) if len(code) else n, lower[begin]]


def _merged(batches, read=bytes):
    """(shard, codes, counts, below) of each shard, from blocks that come sorted by shard; ``read`` opens a block's column."""
    shard, held, fresh = None, ([], [], []), 0
    for batch in batches:
        for own, *block in zip(batch.column("shard").to_pylist(), *(batch.column(c) for c in ("codes", "counts", "below")), strict=True):
            if own != shard and held[0]:
                yield shard, *_added(*held)
                held, fresh = ([], [], []), 0
            shard = own
            code, n, below = (read(x.as_py()) for x in block)
            n = _unplanes(n, np.uint32)
            for into, x in zip(held, (_unpacked(code, len(n)), n, _unplanes(below, np.uint16)), strict=True):
                into.append(x)
            fresh += len(n)
            if fresh > max(MERGE, len(held[0][0])):  # a shard that has grown is merged the less often
                held, fresh = tuple([x] for x in _added(*held)), 0
    if held[0]:
        yield shard, *_added(*held)


def _manifest(key: int, n: int, path: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([n], pa.int64()), pa.array([path])], names=["key", "n", "path"])


def _word_shards(batches, folder: str, total: int, discount: float):
    got = [[b.column(n).to_numpy() for n in ("word", "n")] for b in batches if b.num_rows]
    if not got:
        return
    word, n = (np.concatenate(x) for x in zip(*got, strict=True))
    word = word.view(np.uint64) ^ _FLIP
    arrays = {f"successors.{k}": v for k, v in EliasFano.build(word).items()}
    empty = EliasFano.build(np.zeros(1, np.uint64))
    arrays |= {f"{name}.{k}": v for name in ("contexts", "pointers") for k, v in empty.items()}
    path = f"{folder}/{uuid.uuid4().hex}.trie"
    log = np.log10(np.maximum(n - discount, 1e-9) / total)
    arrays |= Steps.build("log", _quantised(log)) | Steps.build("back", np.zeros(1, np.uint16))
    save(path, arrays | {"count": n.astype(np.uint32 if n.max() < 2**32 else np.int64)})
    yield _manifest(int(word[:1].view(np.int64)[0]), len(word), path)


def _longer_shards(batches, folder: str):
    """Write the shards whose blocks arrive: sorted (context, position) entries, and a back-off weight for each context."""
    for shard, code, n, lower in _merged(batches, _unzipped):
        context, position = code >> PLACES, code & _PLACE
        begin = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        ends = np.append(begin[1:], len(context))
        size, seen = ends - begin, np.add.reduceat(n, begin)
        back = DISCOUNT * size / seen
        prob = (n - DISCOUNT) / np.repeat(seen, size) + np.repeat(back, size) * 10.0 ** (-STEP * lower)
        top = position[ends - 1].astype(np.uint64) + ONE
        base = np.concatenate([np.zeros(1, np.uint64), np.cumsum(top)[:-1]]).astype(np.uint64)
        arrays = {}
        for name, x in (("contexts", context[begin]), ("pointers", np.append(begin, len(context))), ("successors", position.astype(np.uint64) + np.repeat(base, size))):
            arrays |= {f"{name}.{k}": v for k, v in EliasFano.build(np.asarray(x).astype(np.uint64)).items()}
        path = f"{folder}/{uuid.uuid4().hex}.trie"
        save(path, arrays | Steps.build("log", _quantised(np.log10(prob))) | Steps.build("back", _quantised(np.log10(back))))
        yield _manifest(shard, len(code), path)
        texts.give_back()


def _score_batches(batches, model):
    held = Model(*model.value)
    rare = np.log10(held.unknown)
    for batch in batches:
        for part in _slices(batch):
            p = Positions(part)
            n, known = len(p.ids), p.ids >= 0
            # whole numbers of steps, so that equal texts have equal sums
            steps, alone = np.zeros(n, dtype=np.int64), known
            if len(held.levels) > 1:
                p.look_up_pairs(held)
                steps = np.where(p.pair >= 0, p.pair_log, p.pair_back)
                alone = known & (p.pair < 0)
            if alone.any():  # what is no known pair backs off to the word
                ids, at = np.unique(p.ids[alone], return_inverse=True)
                steps[alone] += held.levels[0].values(ids, "log")[at]
            if len(held.levels) > 2:
                rows = np.flatnonzero(p.long_context >= 0)
                # each run once and in order, also those whose last two words are no known pair (position -1)
                code, at = np.unique(p.long_context[rows] << PLACES | (p.position[rows] + 1), return_inverse=True)
                entry, log, _, back = held.levels[2].find(code >> PLACES, (code & _PLACE) - 1)
                steps[rows] = np.where((entry >= 0)[at], log[at], steps[rows] + back[at])
            score = -STEP * _per_text(steps, p.firsts) + rare * _per_text((~known).astype(np.int64), p.firsts)
            columns = [part.column(c) for c in ("doc_id", "held_out", "n_known", "base_score")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(p.firsts)), pa.array(score)], names=["doc_id", "held_out", "n_known", "base_score", "n_tokens", "score"])


def _built(rows: DataFrame, build) -> list[tuple[int, int, str]]:
    made = rows.mapInArrow(build, "key long, n long, path string").collect()
    return sorted(((r.key, r.n, r.path) for r in made), key=lambda s: s[0] % 2**64)


def _words(docs: DataFrame, folder: str) -> tuple:
    """(total, distinct, unknown, [words]) of the texts."""
    words = settled(docs.select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total, distinct, once, twice = words.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    if not total:
        return (0, 0, 1.0, [])
    if distinct >= _PLACE:
        raise ValueError(f"more than {_PLACE} distinct words")
    # without words seen twice, or next to none, the estimate comes to 1, and would leave words seen once no mass
    discount = min(once / (once + 2 * twice), MOST_DISCOUNT) if once and twice else DISCOUNT if once else 0.0
    dealt = words.repartitionByRange("word").sortWithinPartitions("word")
    level = _built(dealt, partial(_word_shards, folder=folder, total=total, discount=discount))
    released(words)
    del words, dealt
    shuffles_dropped(docs.sparkSession)
    return (total, distinct, max(discount * distinct / total, 1 / (total + distinct + 1)), [level])


def fit(docs: DataFrame, train: Column | None = None, orders: int = 3) -> tuple[tuple, DataFrame]:
    """The model of the texts of the rows where ``train`` holds (else of all), up to triples, and the rows as word ids.

    The model is (total, distinct, unknown, levels), small and picklable; the rows (doc_id, held_out, n_known,
    base_score, ids) are settled, and are what ``score`` takes.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/trie-{uuid.uuid4().hex}"
    system, place = _system(folder)
    system.create_dir(place, recursive=True)
    held_out = F.lit(False) if train is None else ~train
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = _words(docs.where("not held_out"), folder)
    share = spark.sparkContext.broadcast
    rows = settled(docs.mapInArrow(partial(_id_batches, model=share(model)), "doc_id long, held_out boolean, n_known long, base_score double, ids array<int>"), compression="zstd")
    learnt = rows.where("not held_out").select("ids")
    shards = -(-model[0] // SHARD_TOKENS)
    contexts = model[1]
    for order in range(2, orders + 1 if model[0] else 2):
        sent = share(model)
        firsts = np.arange(shards, dtype=np.int64) * contexts // shards
        count = partial(_pair_counts if order == 2 else _triple_counts, firsts=firsts, model=sent)
        blocks = learnt.mapInArrow(count, "shard int, codes binary, counts binary, below binary").repartition(shards, "shard").sortWithinPartitions("shard")
        made = {key: (n, path) for key, n, path in _built(blocks, partial(_longer_shards, folder=folder))}
        del blocks
        shuffles_dropped(spark)
        contexts = sum(n for n, _ in made.values())
        if not contexts:
            break
        if contexts >= 1 << 63 - PLACES:
            raise ValueError(f"more than 2^{63 - PLACES} runs of {order} words")
        model = (*model[:3], [*model[3], [(int(first), *made.get(i, (0, ""))) for i, first in enumerate(firsts)]])
    return model, rows


def score(rows: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, score) of each whole text, by looking the trie up."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(partial(_score_batches, model=sent), "doc_id long, held_out boolean, n_known long, base_score double, n_tokens long, score double")


def scored(docs: DataFrame) -> DataFrame:
    """Scores of all documents by the model of those that are not held out; a null id is not."""
    model, rows = fit(docs, F.coalesce(crc_remainder("doc_id", 7) != 2, F.lit(True)))
    found = score(rows, model)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model[0]).cast("long").alias("train_tokens"), "base_score", "score")
