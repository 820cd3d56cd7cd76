"""K-d tree sharding: weighted medians along the widest metadata dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketflow.llm.common import parts, stored

#: Bins of one round of the search for a median; a round narrows the range by so much.
BINS = 4096
#: Bits of the key that orders points of equal coordinate.
TIE_BITS = 32
#: A group of copies over this share of a shard is ordered by document inside.
HOT_SHARE = 1 / 128


@dataclass
class Node:
    id: int
    shards: int
    first: int  # of its shards
    cut: tuple[int, int, int] | None = None  # dimension, coordinate, tie key: up to and with these go left
    left: int = -1
    right: int = -1


def _leaf_of(nodes: dict[int, Node], dims: list[str], at: int = 0) -> Column:
    """The leaf's first shard, as nested comparisons."""
    node = nodes[at]
    if node.cut is None:
        return F.lit(node.first)
    d, v, u = node.cut
    x = F.col(dims[d])
    return F.when((x < v) | ((x == v) & (F.col("tie") <= u)), _leaf_of(nodes, dims, node.left)).otherwise(_leaf_of(nodes, dims, node.right))


def _search(points: DataFrame, key: dict[int, Column], low: dict[int, int], high: dict[int, int], target: dict[int, float], within: Column | None = None) -> tuple[dict[int, int], dict[int, float]]:
    """For each node the least key whose weight, with all below it, reaches the target.

    Histograms of BINS bins per node, made again inside the bin that holds the
    target until a bin is one value. Each round is one pass over the points and
    gives the driver at most BINS rows per node. Also returns the weight below
    the found key.
    """
    low, high, below = dict(low), dict(high), {n: 0.0 for n in key}
    while True:
        wide = [n for n in key if high[n] > low[n]]
        if not wide:
            return low, below
        step = {n: -(-(high[n] - low[n] + 1) // BINS) for n in wide}
        bin_ = F.lit(None).cast("bigint")
        for n in wide:
            inside = (F.col("node") == n) & key[n].between(low[n], high[n])
            bin_ = F.when(inside, F.floor((key[n] - F.lit(low[n])) / step[n])).otherwise(bin_)
        rows = points if within is None else points.filter(within)
        sums: dict[int, list[tuple[int, int]]] = {n: [] for n in wide}
        for r in rows.select("node", "weight", bin_.alias("bin")).filter("bin IS NOT NULL").groupBy("node", "bin").agg(F.sum("weight").alias("w")).collect():
            sums[r["node"]].append((int(r["bin"]), r["w"]))
        for n in wide:
            for b, w in sorted(sums[n]):
                if below[n] + w >= target[n]:
                    break
                below[n] += w
            low[n], high[n] = low[n] + b * step[n], min(high[n], low[n] + (b + 1) * step[n] - 1)


def kd_tree(points: DataFrame, dims: list[str], shards: int) -> dict[int, Node]:
    """Splits the weighted points until each leaf is one shard.

    ``points``: whole-numbered ``dims``, ``tie`` (0 to 2^32 - 1) and ``weight``. A
    node of k shards is cut where its lower k//2 of k shards' weight ends, along
    the dimension in which it is widest against the whole table. Points of equal
    coordinate are parted by ``tie``. The driver sees bounds and histograms only.
    """
    nodes = {0: Node(0, shards, 0)}
    open_ = [0]
    extent: list[float] = []
    while open_:
        of = points.withColumn("node", _node_of(nodes, dims)).filter(F.col("node").isin(open_))
        found = {
            r["node"]: r
            for r in of.groupBy("node").agg(F.sum("weight").alias("w"), *(f(c).alias(f"{k}{i}") for i, c in enumerate(dims) for k, f in (("lo", F.min), ("hi", F.max)))).collect()
        }
        if not extent and found:
            extent = [max(1, found[0][f"hi{i}"] - found[0][f"lo{i}"]) for i in range(len(dims))]
        split = [n for n in open_ if n in found and nodes[n].shards > 1]
        open_ = []
        if not split:
            continue
        axis = {n: max(range(len(dims)), key=lambda i: ((found[n][f"hi{i}"] - found[n][f"lo{i}"]) / extent[i], -i)) for n in split}
        target = {n: found[n]["w"] * (nodes[n].shards // 2) / nodes[n].shards for n in split}
        key = {n: F.col(dims[axis[n]]) for n in split}
        v, below = _search(of, key, {n: found[n][f"lo{axis[n]}"] for n in split}, {n: found[n][f"hi{axis[n]}"] for n in split}, target)
        at_cut = F.lit(False)
        for n in split:
            at_cut = at_cut | ((F.col("node") == n) & (key[n] == v[n]))
        u, _ = _search(of, {n: F.col("tie") for n in split}, {n: 0 for n in split}, {n: 2**TIE_BITS - 1 for n in split}, {n: target[n] - below[n] for n in split}, at_cut)
        for n in split:
            node = nodes[n]
            k = node.shards // 2
            node.cut, node.left, node.right = (axis[n], v[n], u[n]), len(nodes), len(nodes) + 1
            nodes[node.left] = Node(node.left, k, node.first)
            nodes[node.right] = Node(node.right, node.shards - k, node.first + k)
            open_ += [x for x in (node.left, node.right) if nodes[x].shards > 1]
    return nodes


def _node_of(nodes: dict[int, Node], dims: list[str], at: int = 0) -> Column:
    node = nodes[at]
    if node.cut is None:
        return F.lit(node.id)
    d, v, u = node.cut
    x = F.col(dims[d])
    return F.when((x < v) | ((x == v) & (F.col("tie") <= u)), _node_of(nodes, dims, node.left)).otherwise(_node_of(nodes, dims, node.right))


def shard(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int = 1 << 30,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: shards of near-equal bytes.

    ``size`` is the text's bytes plus 8. There are ``shards`` shards, or as many
    as ``target_bytes`` asks for. The tree's dimensions are the text's size, its
    non-ASCII bytes and its crc32, all of them functions of the text: equal texts
    stay in one shard as long as a group of them is below HOT_SHARE of it.
    Larger groups are ordered by document and cut like anything else, so that a
    third of all rows in one group still gives even shards. A shard's size is off
    by one such group at most at each level of the tree.

    ``slot`` numbers a shard's rows without gaps, by counts of small blocks of
    rows, so that no task has to see a whole shard.

    Null text: size 8, crc32 0. Null doc_ids are rows like any other. Repeated
    rows keep their number. Empty table: no rows. Other columns aren't looked at.
    """
    texts = F.coalesce(F.col(text), F.lit(""))
    n_bytes = F.octet_length(texts).cast("bigint")
    base = stored(
        docs.select(
            F.col(id).alias("doc_id"),
            (n_bytes + 8).alias("size"),
            F.crc32(texts).alias("text_crc32"),
            (n_bytes - F.length(texts)).alias("non_ascii"),
            F.xxhash64(F.col(text)).alias("digest"),
        ),
        "shard_points",
    )
    total, rows = base.agg(F.sum("size"), F.count(F.lit(1))).first()
    shards = shards or parts(total or 0, target_bytes)
    most = (total or 0) / shards * HOT_SHARE
    # copies of one text meet as partial sums; only large groups are looked up, and they are few: under shards / HOT_SHARE
    hot = base.groupBy("digest").agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n")).filter((F.col("w") > most) & (F.col("n") > 1)).select("digest", F.lit(True).alias("hot"))
    tied = base.join(F.broadcast(hot), "digest", "left").withColumn(
        "tie", F.pmod(F.when(F.col("hot"), F.xxhash64("digest", "doc_id")).otherwise(F.xxhash64("digest")), F.lit(2**TIE_BITS))
    )
    dims = ["size", "non_ascii", "text_crc32"]
    points = stored(tied.select("doc_id", *dims, "tie", F.col("size").alias("weight")), "shard_tied")
    nodes = kd_tree(points, dims, shards) if rows else {0: Node(0, 1, 0)}
    placed = points.withColumn("shard", _leaf_of(nodes, dims).cast("int"))
    # gapless numbers: blocks of about 50,000 rows of a shard, counted first
    blocks = parts(rows, shards * 50_000)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = placed.join(starts, ["shard", "block"])
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32")
    return numbered.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.row_number().over(inside) - 1).cast("bigint").alias("slot")
    )
