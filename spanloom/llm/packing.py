"""Cost-balanced packing of tokenised documents into sequences of bounded length.

Every document is cut at multiples of the sequence length: full pieces and one rest, so a piece is known
where its document is tokenised. A sequence costs ``LINEAR`` per token and ``QUADRATIC`` per squared piece
length, as attention stays within pieces. Pieces go, longest first, to the cheapest sequence that has room
for them. Only the number of pieces of each length, at most ``capacity`` numbers however large the corpus,
is needed to plan this: the plan says how many sequences take which lengths, and pieces are matched to its
places by their rank among pieces of the same length. Ranks are counted in parallel.

Defined results: a null text is empty; an empty document has one piece, its end token; documents of any
length are tokenised whole; repeated rows are packed again as documents of their own; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import os
import re
import string
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import texts
from spanloom.llm.shared import settled

CAPACITY = 1024
LINEAR, QUADRATIC = 1.0, 1.0 / 512
#: Distinct chunks whose ids a worker remembers from one slice and task to the next.
REMEMBERED = 600_000
#: Parts in which pieces of one length are ranked.
SLOTS = 4096
_LETTER, _MARK = (np.array([keep(chr(i)) for i in range(128)] + [False] * 128) for keep in (str.isalpha, lambda c: c in string.punctuation and c != "'"))
_rare_space = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def default_tokenizer() -> str:
    """Path of the installed public byte-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkTokenizer:
    """Byte-level BPE ids, encoding each distinct chunk once.

    The pre-tokenizer never joins characters across the start of a white-space run, nor a letter with
    punctuation other than an apostrophe, so a text's ids are those of its chunks: words with at most one
    space before them, and what white space and punctuation is left. Texts with white space beyond ASCII's
    are encoded whole instead.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are what runs in parallel
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.encode_special_tokens = True
        self.feed = self.coder.token_to_id("\u010a")  # the id of a line feed
        # whether a token begins with a blank
        self.blank = np.array([(self.coder.id_to_token(i) or "").startswith("\u0120") for i in range(self.coder.get_vocab_size())])
        # each known chunk's number; by number where its ids lie in ``ids``, and the turn in which it was last seen
        self.known: dict[bytes, int] = {}
        self.starts, self.lengths, self.seen = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.ids, self.turn = np.zeros(0, dtype=np.uint32), 0

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(c.ids, dtype=np.uint32) for c in self.coder.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(self, text: str) -> np.ndarray:
        return self.encoded([text])[0]

    def learned(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of chunks, with starts and lengths.

        Words behind a blank are encoded in a row, as only their first tokens begin with a blank; the others
        as lines of one text, whose feeds are tokens of their own. Chunks that hold a feed stand alone.
        """
        starts, lengths = np.zeros(len(new), dtype=np.int64), np.zeros(len(new), dtype=np.int64)
        word = pc.match_substring_regex(new, "^ [^ \\t-\\r]").to_numpy(zero_copy_only=False)
        fed = pc.match_substring(new, "\n").to_numpy(zero_copy_only=False)
        alone, parts, size = [np.flatnonzero(fed)], [], 0
        for rows, joint in ((np.flatnonzero(word), b""), (np.flatnonzero(~word & ~fed), b"\n")):
            for at in range(0, len(rows), 20000):
                own = rows[at : at + 20000]
                some = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), new.take(pa.array(own)))
                ids = self.whole(pc.binary_join(some, joint)[0].as_py().decode())
                ends = np.flatnonzero(ids == self.feed) if joint else np.flatnonzero(self.blank[ids])[1:]
                if len(ends) != len(own) - 1:
                    alone.append(own)
                    continue
                begin = np.concatenate([[0], ends + len(joint)])
                starts[own], lengths[own] = size + begin, np.append(ends, len(ids)) - begin
                parts.append(ids)
                size += len(ids)
        alone = np.concatenate(alone)
        for i, ids in zip(alone, self.encoded([x.decode() for x in new.take(pa.array(alone)).to_pylist()]), strict=True):
            starts[i], lengths[i] = size, len(ids)
            parts.append(ids)
            size += len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), starts, lengths

    def forget(self) -> None:
        """Keep the half of the known chunks that were seen last."""
        stays = np.zeros(len(self.seen), dtype=bool)
        stays[np.argsort(self.seen, kind="stable")[len(self.seen) // 2 :]] = True
        keep = np.flatnonzero(stays)
        self.known = {chunk: i for i, chunk in enumerate(itertools.compress(self.known, stays.tolist()))}
        to = np.concatenate([[0], np.cumsum(self.lengths[keep])])
        self.ids = self.ids[np.arange(to[-1]) + np.repeat(self.starts[keep] - to[:-1], self.lengths[keep])]
        self.starts, self.lengths, self.seen = to[:-1], self.lengths[keep], self.seen[keep]

    def chunks(self, unique: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each chunk where its ids start in ``ids``, and how many there are."""
        if len(self.known) > REMEMBERED:
            self.forget()
        self.turn += 1
        chunk = unique.to_pylist()
        place = np.fromiter(map(self.known.get, chunk, itertools.repeat(-1)), dtype=np.int64, count=len(chunk))
        missing = np.flatnonzero(place < 0)
        if len(missing):
            ids, starts, lengths = self.learned(unique.take(pa.array(missing)))
            first = len(self.known)
            place[missing] = first + np.arange(len(missing))
            self.known.update(zip(map(chunk.__getitem__, missing.tolist()), range(first, first + len(missing)), strict=True))
            self.starts = np.concatenate([self.starts, starts + len(self.ids)])
            self.lengths, self.ids = np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])
            self.seen = np.concatenate([self.seen, np.zeros(len(missing), dtype=np.int64)])
        self.seen[place] = self.turn
        return self.starts[place], self.lengths[place]


@functools.lru_cache(maxsize=1)
def _coder(path: str) -> ChunkTokenizer:
    """The tokenizer of this worker process: its tasks follow one another and share what it has encoded."""
    return ChunkTokenizer(path)


def chunk_bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks start in ``data``: the pieces of ``\\ ?\\S+|\\s+(?!\\S)|\\s+`` with ASCII white space, cut again
    where an ASCII letter and ASCII punctuation other than an apostrophe meet."""
    space = texts.SPACE[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    start = np.zeros(len(data), dtype=bool)
    first = border[:-1]
    before = np.concatenate([[False], space[:-1]])
    last = np.concatenate([~space[1:] & ~border[1:-1], [False]])  # the next byte is a word's, in the same text
    blank = data == 0x20
    start |= first | (space & ~before)  # a white-space run, or a text
    start |= space & last  # the run's last one stands apart from the rest
    start |= ~space & before & ~np.concatenate([[False], blank[:-1]])  # a word joins only a blank
    letter, mark = _LETTER[data], _MARK[data]
    start[1:] |= (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])
    return np.flatnonzero(start)


def tokenised(data: np.ndarray, offsets: np.ndarray, coder: ChunkTokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and each text's first, with the end."""
    starts = chunk_bounds(data, offsets)
    at = pa.py_buffer(np.concatenate([starts, [len(data)]]).astype(np.int32))
    coded = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, at, pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    where, length = coder.chunks(coded.dictionary)
    code = coded.indices.to_numpy()
    count = length[code]
    to = np.concatenate([[0], np.cumsum(count)])
    ids = coder.ids[np.arange(to[-1]) + np.repeat(where[code] - to[:-1], count)]
    return ids, to[np.searchsorted(starts, offsets)]


def _piece_batches(batches, path: str, capacity: int, end_id: int):
    texts.give_back()  # what the tasks of earlier stages have left in this process
    coder = _coder(path)
    for batch in batches:
        for part in texts.slices(batch, limit=1 << 20):
            data, offsets = texts.flat(part.column("text"))
            ids, firsts = tokenised(data, offsets, coder)
            odd = data.tobytes().decode()
            odd = set() if not _rare_space.search(odd) else {i for i, t in enumerate(part.column("text").to_pylist()) if t and _rare_space.search(t)}
            doc, start, length, crc, tokens = [], [], [], [], []
            for i, name in enumerate(part.column("doc_id").to_pylist()):
                own = coder.whole(part.column("text")[i].as_py()) if i in odd else ids[firsts[i] : firsts[i + 1]]
                own = np.append(own, np.uint32(end_id)).astype("<u4")
                for at in range(0, len(own), capacity):
                    piece = own[at : at + capacity]
                    doc.append(name), start.append(at), length.append(len(piece)), tokens.append(len(own))
                    crc.append(zlib.crc32(piece.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of each document cut at multiples of ``capacity``."""
    return docs.select("doc_id", "text").mapInArrow(
        partial(_piece_batches, path=tokenizer, capacity=capacity, end_id=end_id),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Place ``counts[length]`` pieces of each length; works on groups of sequences that are filled alike.

    Returns rows (length, first rank, number, first sequence, offset): pieces of that length with ranks from
    the first on go to consecutive sequences at that offset. Sequences open at first are as many as the
    tokens need; more are opened for pieces that no open sequence has room for.
    """
    total = sum(n * c for n, c in counts.items())
    opened = -(-total // capacity)
    # groups: (cost, first sequence, number, used), cheapest first
    groups = [(0.0, 0, opened, 0)] if opened else []
    out = []
    for length in sorted(counts, reverse=True):
        left, rank, full = counts[length], 0, []
        price = LINEAR * length + QUADRATIC * length * length
        while left:
            while groups and groups[0][3] + length > capacity:
                full.append(heapq.heappop(groups))
            if not groups:
                per = capacity // length
                more = -(-left // per)
                heapq.heappush(groups, (0.0, opened, more, 0))
                opened += more
            cost, first, number, used = heapq.heappop(groups)
            taken = min(number, left)
            out.append((length, rank, taken, first, used))
            heapq.heappush(groups, (cost + price, first, taken, used + length))
            if taken < number:
                heapq.heappush(groups, (cost, first + taken, number - taken, used))
            left, rank = left - taken, rank + taken
        for group in full:
            if group[3] < capacity:
                heapq.heappush(groups, group)
    return out


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """The pieces with (sequence_id, offset); offsets within a sequence leave no gap."""
    spark = docs.sparkSession
    cut = settled(pieces(docs, tokenizer, capacity, end_id).withColumn("slot", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SLOTS))))
    tally = cut.groupBy("length", "slot").agg(F.count("*").alias("n"))
    counts = {row["length"]: row["n"] for row in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # ranks among pieces of a length: within its slot, moved on by the slots before it
    tally = tally.selectExpr("length", "slot", "sum(n) OVER (PARTITION BY length ORDER BY slot) - n AS before")
    own = cut.selectExpr("*", "row_number() OVER (PARTITION BY length, slot ORDER BY doc_id, start, ids_crc32) - 1 AS own")
    ranked = own.join(tally, ["length", "slot"]).withColumn("rank", F.col("own") + F.col("before"))
    runs: dict[int, list] = {}
    for length, rank, number, first, offset in plan(counts, capacity):
        runs.setdefault(length, []).append((rank, number, first, offset))
    rows = [(length, [(r, n, f, o) for r, n, f, o in sorted(own)]) for length, own in runs.items()]
    places = spark.createDataFrame(rows or [(0, [])], "length long, runs array<struct<rank:long,number:long,first:long,offset:long>>")
    placed = ranked.join(F.broadcast(places), "length").withColumn(
        "run", F.filter("runs", lambda r: (r.rank <= F.col("rank")) & (F.col("rank") < r.rank + r.number))[0]
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("run.first") + F.col("rank") - F.col("run.rank")).alias("sequence_id"), F.col("run.offset").alias("offset"),
    )
