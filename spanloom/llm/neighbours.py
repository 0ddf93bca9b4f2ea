"""Near-duplicate embeddings by NN-descent.

Equal vectors are one node. A first neighbour graph comes from orders of the nodes by the signs of random
projections, in which stretches of nodes are compared; there are more orders the more nodes there are, so
that a pair at the threshold meets as often in a large table as in a small one. Then rounds of local joins
follow until few lists change: the neighbours of a node, in either direction, are compared with one another
where one of them is new, and each node's list takes what is nearer. A list holds ``K`` neighbours, and up
to ``ENLARGED`` while all of them are above the threshold. Then the members of a component that is small or
holds a saturated list are compared with one another in pairs of blocks, which counts the links that a list
has no room for. At last the links of every hundredth vector are counted against all rows; while less than
``AUDIT`` of them were found, further orders and rounds are added.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components links with nothing;
vectors link with those of their own length only; equal vectors are links of each other; ties go to the smaller
id; repeated rows and repeated ids count as vectors of their own; a null id is counted as a link, names no component (a component of null
ids only has none) and is never kept; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.shared import components, grouped, released, settled

K, ENLARGED = 12, 48
ORDERS, BITS, STRETCH = 4, 24, 160
#: Share of the pairs at the threshold that may meet in no order, and of the audited links that must be found.
MISSED, AUDIT = 0.01, 0.995
#: Tables of no more nodes are audited whole; queries of an audit that a driver holds at a time.
WHOLE, QUERIES = 10_000, 4096
#: How often the orders are doubled at most to reach ``AUDIT``.
DOUBLINGS = 12
FEW = 0.005
MEMBERS = 256
SIDE = 24


def _unit(vectors: pa.Array, dim: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    # scaled first, so that squares neither overflow nor vanish
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _edges(a, b, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], names=["a", "b", "s"])


def orders_for(nodes: int, threshold: float) -> int:
    """Orders after which a pair at the threshold has met in a stretch, but for a share of ``MISSED``."""
    agree = 1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi
    # a stretch shares about so many leading signs; its ends part one pair in two or so
    meet = 0.5 * agree ** max(0.0, np.log2(max(nodes, 1) / STRETCH))
    return max(ORDERS, int(np.ceil(np.log(MISSED) / np.log1p(-meet))))


def _code_batches(batches, dim: int, seed: int, orders: int):
    planes = np.random.default_rng(seed).normal(size=(dim, orders * BITS))
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = _unit(batch.column("v"), dim)
        for turn in range(orders):
            codes = (unit @ planes[:, turn * BITS : (turn + 1) * BITS] > 0) @ (1 << np.arange(BITS)[::-1])
            turns = pa.array(np.full(batch.num_rows, turn), pa.int32())
            yield pa.RecordBatch.from_arrays([turns, pa.array(codes, pa.int64()), batch.column("node"), batch.column("v")], names=["turn", "code", "node", "v"])


def _stretch_batches(batches, dim: int, threshold: float):
    """Compare stretches of neighbouring rows; each row's nearest, and the first above the threshold."""

    def compared(rows: pa.Table):
        node = rows.column("node").to_numpy()
        likes = (x := _unit(rows.column("v").combine_chunks(), dim)) @ x.T
        likes[node[:, None] == node[None, :]] = -2  # a stretch may hold the end of one order and the start of the next
        k = min(K, len(node) - 1)
        if k < 1:
            return
        best = np.argpartition(-likes, k - 1, axis=1)[:, :k]
        row = np.repeat(np.arange(len(node)), k)
        real = likes[row, best.ravel()] > -2
        yield _edges(node[row][real], node[best.ravel()][real], likes[row, best.ravel()][real])
        first = np.argmax(likes >= threshold, axis=1)
        some = np.flatnonzero(likes[np.arange(len(node)), first] >= threshold)
        yield _edges(node[some], node[first[some]], likes[some, first[some]])

    held = []
    count = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count >= 2 * STRETCH:
            rows = pa.concat_tables(held)
            full = (count - STRETCH) // STRETCH * STRETCH
            for at in range(0, full, STRETCH):
                yield from compared(rows.slice(at, STRETCH))
            held, count = [rows.slice(full)], count - full
    if count:
        rows = pa.concat_tables(held)
        for at in range(0, count, STRETCH):
            yield from compared(rows.slice(at, STRETCH))


def _join_batches(batches, dim: int, most: int = K):
    """Local joins: among the neighbours of each node, the pairs that improve either one's list.

    A list that is not saturated takes no more than the ``K`` best of a join, so the others are no loss to it.
    """
    for table, cuts in grouped(batches, "a"):
        unit = _unit(table.column("v").chunk(0), dim)
        node, floor, fresh = (table.column(c).to_numpy() for c in ("b", "floor", "fresh"))
        found = [], [], []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if j - i < 2 or not fresh[i:j].any():
                continue
            likes = unit[i:j] @ unit[i:j].T
            good = (likes > floor[i:j, None]) & (fresh[i:j, None] | fresh[None, i:j]) & (node[i:j, None] != node[None, i:j])
            likes = np.where(good, likes, -2)
            k = min(most, j - i - 1)
            best = np.argpartition(-likes, k - 1, axis=1)[:, :k]
            row = np.repeat(np.arange(j - i), k)
            s = likes[row, best.ravel()]
            keep = s > -2
            for out, x in zip(found, (node[i:j][row[keep]], node[i:j][best.ravel()[keep]], s[keep]), strict=True):
                out.append(x)
        if found[0]:
            yield _edges(*map(np.concatenate, found))


def _pair_batches(batches, dim: int, threshold: float):
    """Links between and within two blocks of one component, as weights to add to each member."""
    for table, cuts in grouped(batches, "pair"):
        unit = _unit(table.column("v").chunk(0), dim)
        node, weight, left, right = (table.column(c).to_numpy() for c in ("node", "n", "left", "right"))
        nodes, sums = [], []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            a, b = np.flatnonzero(left[i:j]) + i, np.flatnonzero(right[i:j]) + i
            linked = (unit[a] @ unit[b].T >= threshold) & (node[a][:, None] != node[b][None, :])
            same = len(a) == len(b) and bool((node[a] == node[b]).all())
            nodes.append(node[a]), sums.append(linked @ weight[b])
            if not same:
                nodes.append(node[b]), sums.append(linked.T @ weight[a])
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes), pa.int64()), pa.array(np.concatenate(sums), pa.int64())], names=["node", "links"])


def _kept(edges: DataFrame, threshold: float) -> DataFrame:
    """Lists of the nearest: ``K``, or up to ``ENLARGED`` above the threshold; with the bar for a new one."""
    marks = [F.min(c).alias(c) for c in edges.columns if c not in ("a", "b", "s")]
    one = edges.groupBy("a", "b").agg(F.max("s").alias("s"), *marks)
    near = Window.partitionBy("a").orderBy(F.col("s").desc(), "b")
    one = one.withColumn("rank", F.row_number().over(near)).where(f"rank <= {K} or (rank <= {ENLARGED} and s >= {threshold!r})")
    return one.drop("rank")


def _floors(graph: DataFrame, threshold: float) -> DataFrame:
    ends = graph.groupBy("a").agg(F.count("*").alias("held"), F.min("s").alias("least"))
    bar = F.when(F.col("held") < K, -2.0).when((F.col("held") < ENLARGED) & (F.col("least") > threshold), threshold - 1e-12).otherwise(F.col("least"))
    return ends.select(F.col("a").alias("b"), bar.alias("floor"))


def _first_lists(nodes: DataFrame, dim: int, threshold: float, orders: int, seed: int) -> DataFrame:
    """(a, b, s, fresh): what stretches of ``orders`` orders show."""
    code = partial(_code_batches, dim=dim, seed=seed, orders=orders)
    coded = nodes.select("node", "v").mapInArrow(code, f"turn int, code long, node long, v {nodes.schema['v'].dataType.simpleString()}")
    turn = F.xxhash64("node", "turn")
    ordered = coded.repartitionByRange("turn", "code", turn).sortWithinPartitions("turn", "code", turn)
    edges = ordered.mapInArrow(partial(_stretch_batches, dim=dim, threshold=threshold), "a long, b long, s double")
    return edges.withColumn("fresh", F.lit(True))


def graph(nodes: DataFrame, dim: int, threshold: float, orders: int, seed: int = 11, lists: DataFrame | None = None) -> DataFrame:
    """(a, b, s, fresh): the neighbour lists of ``nodes`` (node, v) after NN-descent, settled.

    ``lists`` are those of an earlier call, which are taken further.
    """
    first = _first_lists(nodes, dim, threshold, orders, seed)
    before, lists = lists, settled(_kept(first if lists is None else lists.unionByName(first), threshold))
    if before is not None:
        released(before)
    enough = FEW * K * nodes.count()
    turn, changed = 0, lists.where("fresh").count()
    while changed > enough:
        turn += 1
        own = lists.select("a", "b", "fresh", F.lit(True).alias("own"))
        both = own.unionByName(lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "fresh", F.lit(False).alias("own")))
        both = both.groupBy("a", "b").agg(F.max("fresh").alias("fresh"), F.max("own").alias("own"))
        # a node's own list is joined whole; of the lists that it stands in, some take part each time
        some = Window.partitionBy("a", "own").orderBy(F.col("fresh").desc(), F.xxhash64("a", "b", F.lit(turn)))
        both = settled(both.withColumn("rank", F.row_number().over(some)).where(f"own or rank <= {SIDE}").select("a", "b", "fresh"))
        valued = both.join(_floors(lists, threshold), "b").join(nodes.select(F.col("node").alias("b"), "v"), "b")
        joined = valued.repartition("a").sortWithinPartitions("a").select("a", "b", "floor", "fresh", "v")
        new = joined.mapInArrow(partial(_join_batches, dim=dim), "a long, b long, s double")
        # an entry is old when both of its nodes have joined it
        done = both.where("fresh").select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(True).alias("done"))
        held = lists.join(done, ["a", "b"], "left").select("a", "b", "s", (F.col("fresh") & F.col("done").isNull()).alias("fresh"), F.lit(False).alias("new"))
        new = new.select("a", "b", "s", F.lit(True).alias("fresh"), F.lit(True).alias("new"))
        after = settled(_kept(held.unionByName(new), threshold))
        released(both), released(lists)
        changed = after.where("new").count()
        lists = after.drop("new")
    return lists


def _completed(nodes: DataFrame, lists: DataFrame, dim: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (node, component) of the nodes with a link, both settled."""
    links = lists.where(F.col("s") >= threshold).select("a", "b")
    links = settled(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    classes = settled(components(links))
    full = lists.groupBy("a").agg(F.count("*").alias("held"), F.min("s").alias("least")).where((F.col("held") >= K) & (F.col("least") >= threshold))
    dense = classes.join(full.select(F.col("a").alias("node")), "node", "left_semi").select("component").distinct().withColumn("dense", F.lit(True))
    sizes = classes.groupBy("component").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("blocks"))
    sizes = sizes.join(dense, "component", "left").where("dense or blocks = 1").drop("dense")
    members = classes.join(sizes, "component").join(nodes, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a block meets every block of its component once: as the left one, as the right one, or as both
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    members = members.select(F.xxhash64("component", low, high).alias("pair"), "node", "n", "v", (F.col("block") == low).alias("left"), (F.col("block") == high).alias("right"))
    dealt = members.repartition("pair").sortWithinPartitions("pair", "node")
    counted = dealt.mapInArrow(partial(_pair_batches, dim=dim, threshold=threshold), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    sparse = links.join(nodes.select(F.col("node").alias("b"), "n"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    totals = sparse.join(counted.withColumnRenamed("links", "dense"), "node", "full").select("node", F.coalesce("dense", "links").alias("links"))
    totals = settled(totals)
    released(links)
    return totals, classes


def _query_batches(batches, dim: int, threshold: float, asked):
    """Links of the asked nodes with the rows of each batch."""
    node, x = asked.value
    sums = np.zeros(len(node), dtype=np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            if part.num_rows:
                linked = (x @ _unit(part.column("v"), dim).T >= threshold) & (node[:, None] != part.column("node").to_numpy()[None, :])
                sums += linked @ part.column("n").to_numpy()
    yield pa.RecordBatch.from_arrays([pa.array(node[sums > 0], pa.int64()), pa.array(sums[sums > 0], pa.int64())], names=["node", "links"])


def true_links(nodes: DataFrame, asked: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, links) of the ``asked`` nodes (node, v) against all ``nodes``, in blocks of queries; settled."""
    spark = nodes.sparkSession
    blocks = -(-asked.count() // QUERIES)
    found = spark.createDataFrame([], "node long, links long")
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("node"), F.lit(blocks)) == block).select("node", "v").toArrow().combine_chunks()
        if some.num_rows:
            unit = _unit(some.column("v").chunk(0), dim)
            held = spark.sparkContext.broadcast((some.column("node").to_numpy(), unit))
            found = found.unionByName(nodes.select("node", "n", "v").mapInArrow(partial(_query_batches, dim=dim, threshold=threshold, asked=held), "node long, links long"))
    return settled(found.groupBy("node").agg(F.sum("links").alias("links")))


def recall(true: DataFrame, totals: DataFrame) -> float:
    """Share of the ``true`` links (node, links) of the audited nodes that ``totals`` counts."""
    both = true.join(totals.withColumnRenamed("links", "found"), "node", "left")
    row = both.agg(F.sum("links").alias("links"), F.sum(F.coalesce("found", F.lit(0))).alias("found")).first()
    return row["found"] / row["links"] if row["links"] else 1.0


def _of_one_length(rows: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(mark, dim, n_links, component_id) of the sound vectors (vec_id, mark, v) of one length."""
    # a node is a vector, whatever ids it has; ids only name what is found
    least = rows.groupBy("mark").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    nodes = settled(rows.select("mark", "v").dropDuplicates(["mark"]).join(least, "mark").select(F.col("mark").alias("node"), "least", "n", "v"))
    count = nodes.count()
    asked = nodes if count <= WHOLE else nodes.join(rows.where("vec_id % 100 = 0").select(F.col("mark").alias("node")).distinct(), "node", "left_semi")
    true = true_links(nodes, asked, dim, threshold)
    orders, seed, lists = orders_for(count, threshold), 11, None
    for _ in range(DOUBLINGS):
        lists = graph(nodes, dim, threshold, orders, seed, lists)
        totals, classes = _completed(nodes, lists, dim, threshold)
        if recall(true, totals) >= AUDIT:
            break
        orders, seed = 2 * orders, seed + 1
        released(totals), released(classes)
    else:
        raise RuntimeError(f"recall of the audited links is below {AUDIT} after {DOUBLINGS} doublings of the orders")
    named = classes.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("first"))
    classes = classes.join(named, "component").select("node", "first")
    result = nodes.select("node", "least", "n").join(totals, "node", "left").join(classes, "node", "left")
    return result.select(F.col("node").alias("mark"), F.lit(dim).alias("dim"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.least("first", "least").alias("component_id"))


def linked(embeddings: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of links at a cosine of ``threshold`` or more, in double precision."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    kind = embeddings.schema["embedding"].dataType.simpleString()
    value = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", value.alias("v"), F.when(F.coalesce(sound, F.lit(False)), F.size("embedding")).alias("dim"))
    rows = rows.withColumn("mark", F.when(F.col("dim").isNotNull(), F.xxhash64("v")))
    every = settled(rows.select("vec_id", "mark", "dim"))
    out = every.withColumns({"n_links": F.lit(None).cast("long"), "component_id": F.lit(None).cast("long")})
    lengths = [r.dim for r in every.where("dim is not null").groupBy("dim").count().where("count > 1").orderBy("dim").collect()]
    if lengths:
        found = [_of_one_length(rows.where(F.col("dim") == dim), dim, threshold) for dim in lengths]
        out = every.join(reduce(DataFrame.unionByName, found), ["mark", "dim"], "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
