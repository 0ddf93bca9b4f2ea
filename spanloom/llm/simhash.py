"""SimHash near-duplicates, found by pigeonring chains of fingerprint segments.

A fingerprint is a ring of ``m`` segments. If two fingerprints differ in at most ``tau`` bits, then from
some segment on, every chain of ``l`` consecutive segments differs in at most ``l * tau / m`` bits. So
fingerprints are filed under what a chain's start may look like; those that meet are tied to the least of
them, pass the ring's budgets, and then the whole Hamming distance. Members of a bucket that its least
one does not tie are compared in blocks. No step makes all pairs of a group.

``hamming_groups`` is complete: with three segments and a distance of two, some segment is equal and the
chain of it and the next one differs in one bit, so one half of the next is equal too; fingerprints are
filed under the segment and either half. ``near_groups`` asks for a Jaccard similarity, which bits only
estimate. Its chains start within ``tau // m`` bits; a fingerprint is filed under each segment and its likeliest
changes, those of the bits that the fewest shingles decided, which finds all but about one in a hundred
pairs at 0.8; the ring and Hamming budgets are wide enough to keep them, and the exact similarity decides.

Defined results: a null text counts as empty; a text without words has fingerprint zero and is linked like
any other; a text of fewer words than a shingle is one shingle; repeated rows get the same result; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from functools import partial
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm import texts
from spanloom.llm.shared import bucket_components, buckets, compared, components, hubs, kept, marked, marks, mixed_by, parted_by, released, scratch, settled, shuffles_dropped, tied

SEED = 42


def _votes(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """For each text and bit of its hashes (rows of one or more 64-bit words), twice the set ones less all."""
    bits = 64 * hashes.shape[1]
    out = np.zeros((len(firsts) - 1, bits), dtype=np.int64)
    for i in np.flatnonzero(np.diff(firsts)):
        own = hashes[firsts[i] : firsts[i + 1]]
        for at in range(0, len(own), 200):  # few enough that a byte holds each count
            rows = np.unpackbits(own[at : at + 200].view(np.uint8), axis=1, bitorder="little")
            out[i] += np.add.reduce(rows, axis=0, dtype=np.uint8)
    return 2 * out - np.diff(firsts)[:, None]


def _exact_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each space-joined run of ``k`` lower-case words, and each text's first, with the end."""
    starts, ends, firsts = texts.word_bounds(data, offsets)
    lengths = np.diff(firsts)
    counts = np.where(lengths == 0, 0, np.maximum(1, lengths - k + 1))
    to = np.concatenate([[0], np.cumsum(counts)])
    low = texts.LOWER[data].tobytes()
    digest, hashes = xxhash.xxh64_intdigest, np.zeros(to[-1], dtype=np.uint64)
    for i in np.flatnonzero(counts):
        plain = b" ".join(low[offsets[i] : offsets[i + 1]].split())
        size = ends[firsts[i] : firsts[i + 1]] - starts[firsts[i] : firsts[i + 1]]
        end = np.cumsum(size + 1) - 1
        begin = (end - size)[: counts[i]].tolist()
        end = end[k - 1 :].tolist() or [len(plain)]
        hashes[to[i] : to[i + 1]] = [digest(plain[x:y], SEED) for x, y in zip(begin, end, strict=True)]
    return hashes, to


def _shingles(part: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = texts.flat(part.column("text"))
    starts, ends, words = texts.word_bounds(data, offsets)
    return texts.shingles(texts.word_hashes(texts.LOWER[data], starts, ends), words, k)


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(rows.ravel()))


def _fingerprint_batches(batches, k: int, blocks: int, keep: list[str]):
    for batch in batches:
        for part in texts.slices(batch):
            if blocks == 1:
                hashes, firsts = _exact_shingles(*texts.flat(part.column("text")), k)
                hashes = hashes[:, None]
            else:
                hashes, firsts = _shingles(part, k)
                hashes = np.stack([texts.mix(hashes + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64)) for j in range(blocks)], axis=1)
            votes = _votes(hashes, firsts)
            columns, names = [*(part.column(c) for c in keep)], [*keep, "prints"]
            columns.append(_lists(np.packbits(votes > 0, axis=1, bitorder="little").view(np.int64)))
            if blocks > 1:
                near = np.argsort(np.abs(votes).reshape(len(votes), -1, WIDTH), axis=2, kind="stable")[:, :, :WEAK]
                columns.append(_lists((near << (5 * np.arange(WEAK))).sum(axis=2)))
                names.append("weak")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def mark() -> Column:
    """A hash of the whole text; equal texts are one node."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = 5, blocks: int = 1) -> DataFrame:
    """(doc_id, mark, prints): ``blocks`` SimHash words of 64 bits over the shingles, repeats included.

    One block takes XXH64 with seed 42 of the space-joined words; further blocks take independent
    scramblings of a 64-bit hash, and then ``weak`` has, for each segment of ``WIDTH`` bits, the places of
    the ``WEAK`` bits with the closest votes, five bits for each.
    """
    schema = "doc_id long, mark long, prints array<long>" + (", weak array<long>" if blocks > 1 else "")
    return docs.select("doc_id", "text", mark().alias("mark")).mapInArrow(partial(_fingerprint_batches, k=shingle, blocks=blocks, keep=["doc_id", "mark"]), schema)


def on_ring(a: list[Column], b: list[Column], tau: int) -> Column:
    """Whether from some segment on all chains keep within their share of ``tau``, the segment itself as the first."""
    m = len(a)
    apart = F.array(*[F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)])

    def keeps(ring: Column, i: Column) -> Column:
        total = lambda length: F.aggregate(F.slice(ring, i + 1, length), F.lit(0), lambda t, x: t + x)
        return F.forall(F.sequence(F.lit(1), F.lit(m)), lambda length: total(length) <= F.floor(length * tau / m))

    # the array holds the ring twice, and is bound once for all its uses
    return F.transform(F.array(F.concat(apart, apart)), lambda ring: F.exists(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: keeps(ring, i)))[0]


def _near_prints(left: list[np.ndarray], right: list[np.ndarray], tau: int) -> np.ndarray:
    p, q = (np.stack(side).view(np.uint64) for side in (left, right))
    apart = np.zeros((len(p), len(q)), dtype=np.int64)
    for i in range(p.shape[1]):
        apart += np.bitwise_count(p[:, i][:, None] ^ q[:, i][None, :])
    return apart <= tau


#: Segments of a 64-bit ring: first bit and width.
RING = ((0, 22), (22, 21), (43, 21))


def _bits(value: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(value, first).bitwiseAND(F.lit((1 << width) - 1))


def chain_keys(node: Column, tau: int) -> Column:
    """What a 64-bit fingerprint is filed under: a segment, and from two bits on a half of the next one beside it."""
    keys = []
    for i, (first, width) in enumerate(RING):
        if tau < 2:  # chains of up to two segments are equal: the next one whole
            halves = [RING[(i + 1) % 3]]
        else:
            start, size = RING[(i + 1) % 3]
            halves = [(start, size // 2), (start + size // 2, size - size // 2)]
        keys += [F.xxhash64(F.lit(3 * j + i), _bits(node, first, width), _bits(node, *half)) for j, half in enumerate(halves)]
    return F.array(*keys)


def candidates(nodes: DataFrame, tau: int) -> DataFrame:
    """(key, node, root) of the fingerprints that meet under a chain's start."""
    return buckets(nodes.select("node", F.explode(chain_keys(F.col("node"), tau)).alias("key")))


def within_ring(met: DataFrame, tau: int) -> DataFrame:
    """The pairs (a, b) of fingerprints whose chains keep within their budgets from some segment on."""
    a, b = ([_bits(F.col(x), *segment) for segment in RING] for x in "ab")
    return met.where(on_ring(a, b, tau))


def hamming_groups(docs: DataFrame, shingle: int = 5, tau: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of 64-bit fingerprints linked at ``tau`` (2 at most) differing bits."""
    if not 0 <= tau <= 2:
        raise ValueError("tau must be 0, 1 or 2")
    each = settled(fingerprints(docs, shingle).select("doc_id", F.col("prints")[0].alias("node")))
    unique = each.groupBy("node").agg(F.min("doc_id").alias("least"))
    met = candidates(unique, tau)
    pairs = met.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
    links = within_ring(pairs, tau).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= tau)
    values = unique.select("node", F.array("node").alias("prints"))
    found = bucket_components(met, links, values, partial(_near_prints, tau=tau))
    roots = found.join(unique, "node").groupBy("component").agg(F.min("least").alias("component_id"))
    classes = unique.join(found, "node", "left").join(roots, "component", "left")
    classes = classes.select("node", F.coalesce("component_id", "least").alias("component_id"))
    return each.join(classes, "node").select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


#: Words of a long fingerprint, bits of its segments, bits of a segment whose votes are closest, and ways to file one.
BLOCKS, WIDTH, WEAK, WAYS = 5, 32, 8, 32


def changes(similarity: float = 0.8) -> list[tuple[int, ...]]:
    """The ``WAYS`` likeliest changes of a segment, as ranks among its bits by closeness of the vote, none first.

    Votes of alike sets are about normal with the cosine as correlation; the vote of rank r of n lies about
    where the normal distribution has half of (r + 1/2) / n of its mass on either side of zero.
    """
    normal, cosine = NormalDist(), 2 * similarity / (1 + similarity)
    turn = [normal.cdf(-cosine / (1 - cosine**2) ** 0.5 * normal.inv_cdf(0.5 + (r + 0.5) / (2 * WIDTH))) for r in range(WEAK)]
    cost = lambda ranks: sum(math.log((1 - turn[r]) / turn[r]) for r in ranks)
    every = itertools.chain.from_iterable(itertools.combinations(range(WEAK), n) for n in range(5))
    return sorted(every, key=lambda ranks: (cost(ranks), ranks))[:WAYS]


def _key_batches(batches):
    """(key, node): each segment of the prints with each of its likeliest changes."""
    ways = changes()
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            prints, weak = (np.stack([np.asarray(x.values) for x in part.column(c)]) for c in ("prints", "weak"))
            segments = prints.view(np.uint32).reshape(len(prints), -1).astype(np.uint64)  # little end first, as the votes' bits
            flips = np.uint64(1) << ((weak[:, :, None].view(np.uint64) >> (np.uint64(5) * np.arange(WEAK, dtype=np.uint64))) & np.uint64(31))
            change = np.stack([np.bitwise_or.reduce(flips[:, :, list(way)], axis=2) if way else np.zeros_like(segments) for way in ways], axis=2)
            tag = np.arange(segments.shape[1], dtype=np.uint64)[None, :, None] << np.uint64(WIDTH)
            key = (segments[:, :, None] ^ change) | tag
            node = np.repeat(part.column("node").to_numpy(), key.shape[1] * key.shape[2])
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(node)], names=["key", "node"])


def most_apart(similarity: float, bits: int) -> int:
    """Bits that shingle sets of that Jaccard similarity differ in, and two and a half standard deviations more."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * share + 2.5 * (bits * share * (1 - share)) ** 0.5)


def _set_batches(batches, k: int, wanted):
    """Node and distinct shingles of the texts whose node is marked."""
    bits = np.frombuffer(wanted.value, dtype=np.uint64)
    for batch in batches:
        batch = batch.filter(pa.array(marked(batch.column("node").to_numpy().view(np.uint64), bits)))
        for part in texts.slices(batch):
            hashes, firsts = _shingles(part, k)
            sets = [np.unique(hashes[i:j]).view(np.int64) for i, j in zip(firsts[:-1], firsts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "sure"])


def _sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, sure): the distinct shingles of those texts; settled."""
    wanted = docs.sparkSession.sparkContext.broadcast(marks(nodes))
    rows = docs.select(mark().alias("node"), "text").mapInArrow(partial(_set_batches, k=shingle, wanted=wanted), "node long, sure array<long>")
    return settled(rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("sure").alias("sure")))


def _sure(left: np.ndarray, right: np.ndarray, similarity: float) -> bool:
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared >= similarity * (len(left) + len(right) - shared)


def near_links(docs: DataFrame, unique: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (a, b) that tie the nodes of ``unique`` (node, prints, weak) as do links between texts of ``docs`` with that Jaccard similarity or more."""
    tau = most_apart(similarity, 64 * BLOCKS)
    prints = unique.select("node", "prints")
    left, right = prints.selectExpr("node AS a", "prints AS p"), prints.selectExpr("node AS b", "prints AS q")
    p, q = ([_bits(F.col(x)[i], at, WIDTH) for i in range(BLOCKS) for at in range(0, 64, WIDTH)] for x in "pq")
    apart = sum((F.bit_count(F.col("p")[i].bitwiseXOR(F.col("q")[i])) for i in range(BLOCKS)), F.lit(0))
    near = lambda pairs: settled(pairs.join(left, "a").join(right, "b").where(on_ring(p, q, tau)).where(apart <= tau).select("a", "b"))
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("node"))

    def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        both = pairs.join(sets.selectExpr("node AS a", "sure AS s"), "a").join(sets.selectExpr("node AS b", "sure AS t"), "b")
        shared = F.size(F.array_intersect("s", "t"))
        return settled(both.where(shared >= similarity * (F.size("s") + F.size("t") - shared)).select("a", "b"))

    spark = docs.sparkSession
    met = buckets(unique.select("node", "prints", "weak").mapInArrow(_key_batches, "key long, node long"))
    # first each fingerprint with the least one that it meets anywhere, and with the one of those it meets that meets
    # the most others, such as the text that many near copies were made from: that ties most of a large group
    least = met.where("node <> root").groupBy(F.col("node").alias("a")).agg(F.min("root").alias("b"))
    stars = near(least.unionByName(hubs(met)).distinct())
    sets = _sets(docs, ends(stars).distinct(), shingle)
    # components once found stand for the links that made them, so that none is looked for twice
    found = components(alike(stars, sets))
    released(stars), released(sets)
    del least
    shuffles_dropped(spark)
    # then what shares a bucket and is not tied: pairs, and larger buckets by bits before by shingles
    pairs, members = parted_by(met, found)
    pairs, screened = near(pairs), partial(_near_prints, tau=tau)
    rest = settled(compared(members, prints, screened, links=False).distinct())
    released(met)
    del members
    shuffles_dropped(spark)
    sets = _sets(docs, ends(pairs).unionByName(rest.select("node")).distinct(), shingle)
    found = components(tied(found).unionByName(alike(pairs, sets)))
    more = compared(mixed_by(rest, found, 2), prints.join(sets, "node"), screened, partial(_sure, similarity=similarity))
    return tied(found).unionByName(more)


def near_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, mark, group_id): documents whose shingle sets have that Jaccard similarity, or a chain of such.

    ``mark`` is a hash of the text; equal texts are one node.
    """
    each = settled(fingerprints(docs, shingle, BLOCKS))
    words = lambda c, n: F.array(*[F.min(F.col(c)[i]) for i in range(n)]).alias(c)
    unique = each.groupBy(F.col("mark").alias("node")).agg(F.min("doc_id").alias("least"), words("prints", BLOCKS), words("weak", 64 * BLOCKS // WIDTH))
    unique = settled(unique)
    with scratch():
        found = kept(components(near_links(docs, unique, shingle, similarity)))
    shuffles_dropped(docs.sparkSession)
    roots = found.join(unique, "node").groupBy("component").agg(F.min("least").alias("group_id"))
    groups = unique.join(found, "node", "left").join(roots, "component", "left")
    groups = groups.select("node", F.coalesce("group_id", "least").alias("group_id"))
    return each.join(groups, F.col("mark") == F.col("node")).select("doc_id", "mark", "group_id")


def one_of_each(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents with one row of each group of near copies: the one with the smallest doc_id."""
    # one key column on either side, so that dropping repeated rows needs no shuffle after the join's
    keep = near_groups(docs, shingle, similarity).where("doc_id <=> group_id").select(F.xxhash64("doc_id", "mark").alias("__k")).distinct()
    return docs.withColumn("__k", F.xxhash64("doc_id", mark())).join(keep, "__k").dropDuplicates(["__k"]).select(*docs.columns)
