"""Settled intermediate tables, connected components and other plumbing of the operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir`` where it is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not _own_folder:
            _own_folder.append(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        folder = _own_folder[0]
    return folder.rstrip("/")


#: Frames that the open ``scratch`` blocks have settled, innermost last.
_scratch: list[list[DataFrame]] = []


def settled(frame: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write a frame to the shared folder and read it again: lost executors then cost no recomputation of it."""
    path = f"{shared_folder(frame.sparkSession)}/settled-{uuid.uuid4().hex}"
    frame.write.parquet(path, compression=compression)
    out = frame.sparkSession.read.schema(frame.schema).parquet(path)
    if _scratch:
        _scratch[-1].append(out)
    return out


@contextmanager
def scratch():
    """Frames settled inside the block are removed at its end, but for those that ``kept`` has passed out of it."""
    held: list[DataFrame] = []
    _scratch.append(held)
    try:
        yield
    finally:
        _scratch.remove(held)
        for frame in held:
            released(frame)


def kept(frame: DataFrame) -> DataFrame:
    """A frame settled beyond the innermost ``scratch`` block."""
    inner = _scratch.pop()
    try:
        return settled(frame)
    finally:
        _scratch.append(inner)


def released(frame: DataFrame) -> None:
    """Remove the files of a settled frame that nothing reads any more."""
    spark = frame.sparkSession
    try:
        files = frame.inputFiles()[:1]
    except AnalysisException:  # its files are gone already
        return
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if path.getName().startswith("settled-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffles_dropped(spark: SparkSession) -> None:
    """Let go of the shuffle files of frames that are no longer used: Spark removes them once the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


#: Rounds of ``components`` whose shuffle files may be there at once.
ROUNDS_HELD = 3


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 200) -> DataFrame:
    """Connected components of undirected links: (node, component), component being the smallest node.

    Alternates large-star and small-star steps: each node's larger neighbours, then its smaller ones,
    are hung on its smallest neighbour. Neighbourhoods are only ever reduced by ``min`` and joined, so
    a node with very many links is never held in one task. Only nodes with a link are returned. Links that are
    stars already take no round. Shuffle files, many and small, go every ``ROUNDS_HELD`` rounds.
    """
    edges = settled(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    for done in range(most_rounds):
        if _are_stars(edges):
            break
        if done % ROUNDS_HELD == ROUNDS_HELD - 1:
            least = large = small = after = None  # nothing holds the shuffles of these
            shuffles_dropped(links.sparkSession)
        least = _both_ways(edges).groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("m", "u").alias("m"))
        # one shuffle by node serves the least neighbour and the join with it
        large = edges.join(least, "v").select("u", F.col("m").alias("v")).repartition("u")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).where("u <> v").distinct()
        after = settled(small)
        released(edges)
        edges = after
    else:
        raise RuntimeError(f"components have not settled after {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of distinct edges (u, v), u above v, hangs on one other, or others on it, but not both."""
    ends = _both_ways(edges).select(F.col("u").alias("node"), (F.col("u") > F.col("v")).cast("long").alias("up"))
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return not sums.where("up > 0 AND n > 1").take(1)


def tied(found: DataFrame) -> DataFrame:
    """Links (a, b) that tie the components of ``found`` (node, component): of each node with the smallest."""
    return found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def buckets(rows: DataFrame) -> DataFrame:
    """(key, node, root): the distinct nodes of each key that has two or more, with the least of them; settled.

    ``rows`` holds long columns ``key`` and ``node``. They are dealt by key once and sorted with spill; a task
    streams over its runs. A key alone with its node, as most are, goes no further.
    """
    # these rows shrink so much in a shuffle file that partitions merged by its size would be large in memory
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("key", "node").repartition(parts, F.col("key")).sortWithinPartitions("key", "node")
    return settled(dealt.mapInArrow(_run_batches, "key long, node long, root long"))


def hubs(met: DataFrame) -> DataFrame:
    """(a, b): for each node of ``met`` (key, node), of those it meets the one that is in the most buckets."""
    parts = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a node has a bounded number of keys, so they are counted where they are dealt by node, without a join
    counted = met.select("key", "node").withColumn("n", F.count("*").over(Window.partitionBy("node")))
    dealt = counted.select("key", "node", "n").repartition(parts, F.col("key")).sortWithinPartitions("key", F.desc("n"), F.desc("node"))
    found = dealt.mapInArrow(_hub_batches, "node long, n long, hub long")
    return found.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("n", "hub")).alias("top")).select("a", F.col("top.hub").alias("b"))


def _hub_batches(batches):
    """For each node of a batch the first one, with the largest count, of the runs of keys that it is in."""
    last = None  # key, count and node of the open run's first row
    for batch in batches:
        key, node, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(key):
            continue
        fresh = np.concatenate([[last is None or key[0] != last[0]], key[1:] != key[:-1]])
        run = np.cumsum(fresh)
        top, hub = (np.concatenate([[last[i] if last else 0], x[fresh]]) for i, x in ((1, n), (2, node)))
        last = key[-1], top[run[-1]], hub[run[-1]]
        top, hub = top[run], hub[run]
        good = np.flatnonzero(node != hub)
        good = good[np.lexsort((hub[good], top[good], node[good]))]
        good = good[np.append(node[good][1:] != node[good][:-1], True)] if len(good) else good
        yield pa.RecordBatch.from_arrays([pa.array(x[good], pa.int64()) for x in (node, top, hub)], names=["node", "n", "hub"])


def _run_batches(batches):
    last = None  # key, root, newest node of the open run, and whether its root has been given out
    for batch in batches:
        key, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(key):
            continue
        joins = last is not None and key[0] == last[0]
        fresh = np.concatenate([[not joins], key[1:] != key[:-1]])
        begin = np.flatnonzero(fresh)
        run = np.cumsum(fresh)  # 0: the run that an earlier batch began
        roots = np.concatenate([[last[1] if joins else 0], node[begin]])
        new = np.concatenate([[joins and node[0] != last[2]], node[1:] != node[:-1]]) & ~fresh
        several = np.bincount(run[new], minlength=len(roots)) > 0
        heads = several.copy()
        heads[0] &= joins and not last[3]
        keys = np.concatenate([[last[0] if joins else 0], key[begin]])
        out = np.concatenate([keys[heads], key[new]]), np.concatenate([roots[heads], node[new]]), np.concatenate([roots[heads], roots[run[new]]])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["key", "node", "root"])
        told = bool(several[run[-1]]) or (run[-1] == 0 and last[3])
        last = key[-1], roots[run[-1]], node[-1], told


#: Members of a block of a bucket, and of a group of buckets; two blocks are compared at a time.
BLOCK, GROUP_BLOCK = 1024, 256
#: A block of a large bucket has this many times the square root of its members, so that the rows that blocks are given out
#: as grow with the power 1.5 of the members, not the square; and the left members that are compared with the right ones at once.
BLOCK_ROOT, STRIP = 8, 256
#: About how many compares cost as much as it does to move one member of a block.
ROW_COST = 512


def _tagged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (key, node) with their component by ``found`` (node, component)."""
    return rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _mixed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The keys of ``rows`` (key, node) whose nodes are not all in one component of ``found``."""
    parts = _tagged(rows, found).groupBy("key", "component").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark"), F.min("node").alias("low"), F.max("node").alias("high"))
    whole = parts.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), F.sum("mark").alias("mark"), F.max(F.struct("n", "component")).alias("top"), F.min("low").alias("low"), F.max("high").alias("high"))
    return whole.where("parts > 1")


def mixed_buckets(rows: DataFrame, links: DataFrame, least: int = 3) -> DataFrame:
    """(pair, key, node, component, left, right): members of buckets that ``links`` (a, b) do not tie together.

    ``rows`` (key, node) are distinct. A bucket whose members are all in one component is left out, and of
    buckets with the same members one is taken. Buckets have ``least`` members or more (of two, ``links`` has
    judged the only pair). The members outside a bucket's largest component are cut into blocks, and so are
    those inside; a ``pair`` is two blocks of a key, at least one of them outside.
    """
    return mixed_by(rows, components(links), least)


def mixed_by(rows: DataFrame, found: DataFrame, least: int = 3) -> DataFrame:
    """``mixed_buckets`` of links with the components ``found`` (node, component)."""
    return _in_blocks(rows, found, _once(_mixed(rows, found), least))


def _once(whole: DataFrame, least: int) -> DataFrame:
    """(key, n, top, low) of one of all buckets with the same members, of those of ``least`` members or more."""
    return whole.where(f"n >= {least}").groupBy("n", "mark").agg(F.min(F.struct("key", "top", "low")).alias("one")).select("one.key", "n", "one.top", "one.low")


def _met_over_and_over(met: DataFrame, whole: DataFrame) -> DataFrame:
    """(node, group): what buckets tie together, directly or by chains, where to compare all with all costs no more than bucket by bucket.

    ``met`` (key, node, root) are all buckets, ``whole`` (n, low) those that are to be compared. A large family of
    alike texts meets in hundreds of buckets that are nearly the same; its members are then listed and compared once.
    """
    # a node meets at most as many roots as it has keys; all of them are tied to the least, so that few links are left
    ties = met.where("node <> root").select("node", "root").distinct().withColumn("least", F.min("root").over(Window.partitionBy("node")))
    ends = lambda c: ties.select(F.col(c).alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    groups = settled(components(ends("node").unionByName(ends("root"))))
    cost = whole.groupBy("low").agg(F.sum(F.col("n") * (F.col("n") + F.lit(float(ROW_COST)))).alias("cost")).join(groups.withColumnRenamed("node", "low"), "low")
    cost = cost.groupBy("component").agg(F.sum("cost").alias("cost"))
    size = groups.groupBy("component").agg(F.count("*").cast("double").alias("size"))
    dense = size.join(cost, "component").where(F.col("size") * (F.col("size") + ROW_COST * _blocks("size", GROUP_BLOCK)) <= F.col("cost")).select("component")
    return settled(groups.join(dense, "component").select("node", F.col("component").alias("group")))


def parted_buckets(met: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) that are a bucket of two in different components, and ``mixed_buckets`` of three or more.

    ``met`` (key, node, root) are those of ``buckets``. The buckets of a family that meets over and over are taken
    together as one, which compares all that they do.
    """
    return parted_by(met, components(links))


def parted_by(met: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``parted_buckets`` of links with the components ``found`` (node, component)."""
    rows = met.select("key", "node")
    whole = settled(_mixed(rows, found))
    pairs = whole.where("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b")).distinct()
    whole = settled(_once(whole, 3))
    groups = _met_over_and_over(met, whole)
    apart = _in_blocks(rows, found, whole.join(groups.select(F.col("node").alias("low")), "low", "left_anti"))
    rows = groups.select(F.col("group").alias("key"), "node")
    return pairs, apart.unionByName(_in_blocks(rows, found, _once(_mixed(rows, found), 2), GROUP_BLOCK))


def _blocks(n: Column | str, size: int) -> Column:
    """Into how many blocks of at least ``size`` so many members are cut."""
    n = F.col(n) if isinstance(n, str) else n
    return F.ceil(n / F.greatest(F.lit(float(size)), BLOCK_ROOT * F.sqrt(n))).cast("int")


def _in_blocks(rows: DataFrame, found: DataFrame, whole: DataFrame, size: int | None = None) -> DataFrame:
    size = size or BLOCK
    whole = whole.select("key", F.col("top.component").alias("top"), _blocks(F.col("top.n"), size).alias("inside"), _blocks(F.col("n") - F.col("top.n"), size).alias("outside"))
    rows = _tagged(rows.join(whole, "key"), found).withColumn("inner", F.col("component") == F.col("top"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("inner"), F.col("inside")).otherwise(F.col("outside"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    pair = lambda kind, i, j, left, right: F.struct(F.xxhash64("key", F.lit(kind), i, j).alias("pair"), left.alias("left"), right.alias("right"))
    block, yes, no = F.col("block"), F.lit(True), F.lit(False)
    inner = F.transform(upto(F.col("outside")), lambda j: pair(0, block, j, yes, no))
    outer = F.concat(F.transform(upto(F.col("inside")), lambda i: pair(0, i, block, no, yes)),
                     F.transform(upto(F.col("outside")), lambda j: pair(1, F.least(block, j), F.greatest(block, j), block <= j, block >= j)))
    rows = rows.withColumn("pairs", F.explode(F.when(F.col("inner"), inner).otherwise(outer)))
    return rows.select("pairs.pair", "key", "node", "component", "pairs.left", "pairs.right")


def grouped(batches, key: str):
    """Whole groups of rows that arrive sorted by ``key``: a table of some groups, and where each begins, with the end."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        ids = table.column(key).to_numpy()
        cuts = np.flatnonzero(ids[1:] != ids[:-1]) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield table.slice(0, last).combine_chunks(), np.concatenate([[0], cuts])
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def _near_members(batches, column: str, check, confirm, links: bool):
    """What ``check`` finds alike across components in pairs of blocks: links (a, b) as a forest over the components, or members (key, node).

    ``check`` gets the lists of ``column`` of the left and the right members and returns a matrix of truths;
    ``confirm`` gets the lists ``sure`` of two members and decides, if given.
    """
    names = ("a", "b") if links else ("key", "node")
    for table, cuts in grouped(batches, "pair"):
        key, node, component, left, right = (table.column(c).to_numpy() for c in ("key", "node", "component", "left", "right"))
        lists = {c: (x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)) for c in (column, *(["sure"] if confirm else [])) for x in [table.column(c).chunk(0)]}
        own = lambda c, i: lists[c][1][lists[c][0][i] : lists[c][0][i + 1]]  # noqa: E731, B023
        out = []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            a, b = np.flatnonzero(left[i:j]) + i, np.flatnonzero(right[i:j]) + i
            if not len(a) or not len(b):
                continue
            parent, met, values = {}, set(), [own(column, y) for y in b]
            for at in range(0, len(a), STRIP):
                some = a[at : at + STRIP]
                apart = component[some][:, None] != component[b][None, :]
                if not apart.any():
                    continue
                near = apart & check([own(column, x) for x in some], values)
                if not links:
                    met.update(some[near.any(axis=1)].tolist(), b[near.any(axis=0)].tolist())
                    continue
                for x, y in zip(*np.nonzero(near), strict=True):
                    p, q = int(component[some[x]]), int(component[b[y]])
                    while p in parent:
                        p = parent[p]
                    while q in parent:
                        q = parent[q]
                    if p != q and (confirm is None or confirm(own("sure", some[x]), own("sure", b[y]))):
                        parent[max(p, q)] = min(p, q)
                        out.append((node[some[x]], node[b[y]]))
            out += [(key[x], node[x]) for x in met]
        if out:
            one, two = np.array(out, dtype=np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], names=names)


def compared(members: DataFrame, values: DataFrame, check, confirm=None, links: bool = True) -> DataFrame:
    """Links (a, b) between ``members`` (of ``mixed_buckets``) that ``check`` and ``confirm`` find alike by their
    ``values`` (node, a list of longs, and ``sure``); or the (key, node) of those that ``check`` finds near another."""
    column = next(c for c in values.columns if c not in ("node", "sure"))
    names = ["pair", "key", "node", "component", "left", "right", column, *(["sure"] if confirm else [])]
    dealt = members.join(values, "node").select(*names).repartition("pair").sortWithinPartitions("pair", "node")
    run = partial(_near_members, column=column, check=check, confirm=confirm, links=links)
    return dealt.mapInArrow(run, "a long, b long" if links else "key long, node long")


def bucket_links(rows: DataFrame, links: DataFrame, values: DataFrame, check) -> DataFrame:
    """``links`` (a, b), and those that tie together what is alike in one bucket of ``rows`` (key, node).

    ``links`` may hold a star of each bucket only. A member that is unlike the star's centre can be like
    another member; all members that no link has tied yet are therefore compared by their ``values``
    (node, and one list of longs).
    """
    links = settled(links)
    return links.unionByName(compared(mixed_buckets(rows, links), values, check))


def bucket_components(rows: DataFrame, links: DataFrame, values: DataFrame, check) -> DataFrame:
    """The components (node, component) of ``bucket_links``; those of ``links`` are found once and then added to."""
    found = components(links)
    return components(tied(found).unionByName(compared(mixed_by(rows, found), values, check)))


#: Leading bits of a node that a mark is made of, at least and at most (64 MB), and how many more than it takes to count the nodes.
MARK_BITS, MOST_MARK_BITS, SPARE_BITS = 20, 29, 4
#: Leading bits of a piece of that set. Tasks make the pieces, so that the driver holds no row for each word of the set.
PIECE_BITS = 6


def marks(nodes: DataFrame) -> bytes:
    """A bit set that holds all nodes' leading bits, of at most 64 MB; it only spares work, never decides.

    Its size follows the number of nodes, so that at most one bit in 2^``SPARE_BITS`` is set. Of more nodes than that allows there
    is none (no bytes): everything is marked then, and the joins that follow do all the work.
    """
    bits = max(MARK_BITS, nodes.count().bit_length() + SPARE_BITS)
    if bits > MOST_MARK_BITS:
        return b""
    place = F.shiftrightunsigned("node", 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    rows = nodes.groupBy(F.shiftrightunsigned(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    words = 1 << (bits - 6 - PIECE_BITS)
    dealt = rows.withColumn("piece", F.floor(F.col("word") / words)).repartition("piece")
    made = dealt.mapInArrow(partial(_piece_batches, words=words), "piece long, held binary").toArrow()
    pieces = dict(zip(made.column("piece").to_pylist(), made.column("held"), strict=True))
    return b"".join(pieces[i].as_buffer() if i in pieces else bytes(8 * words) for i in range(1 << PIECE_BITS))


def _piece_batches(batches, words: int):
    """Pieces of ``words`` words, filled with what rows (word, bits, piece) have for them."""
    pieces: dict[int, np.ndarray] = {}
    for batch in batches:
        word, bits, piece = (batch.column(c).to_numpy() for c in ("word", "bits", "piece"))
        for one in np.unique(piece).tolist():
            own = piece == one
            pieces.setdefault(one, np.zeros(words, np.int64))[word[own] % words] = bits[own]
    for one, held in pieces.items():
        yield pa.RecordBatch.from_arrays([pa.array([one], pa.int64()), pa.array([held.tobytes()], pa.binary())], names=["piece", "held"])


def marked(nodes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which nodes (uint64) may be in the set of ``marks``."""
    if not len(bits):
        return np.ones(len(nodes), dtype=bool)
    place = nodes >> np.uint64(64 - (len(bits).bit_length() - 1 + 6))
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
