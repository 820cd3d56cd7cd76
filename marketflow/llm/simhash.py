"""SimHash near-duplicates: vantage-point trees over 64-bit fingerprints."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import parts, stored
from marketflow.llm.components import connected

#: A shard's own points are compared directly once a node holds no more than this.
LEAF = 96
#: Matches held before they are reduced to a forest.
PAIRS = 1_000_000
#: Tokens of sets that are compared with one set at once.
TOKENS = 1 << 22


def shingle_hashes(text: str | None, words: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of each of a text's word shingles, repeats included.

    Words are split at ASCII white space after A-Z are lower-cased. A text of
    fewer words has one shingle, the whole sequence; one without words has none.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(words, len(tokens))
    spans = zip(starts[: len(tokens) - n + 1].tolist(), ends[n - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, len(tokens) - n + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, words: int = 3) -> int:
    """64-bit SimHash of a text's word shingles; 0 without words."""
    hashes = shingle_hashes(text, words)
    return majority(hashes) if len(hashes) else 0


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def split_point(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius that part the points; None if no candidate does.

    Of a few candidates the one whose shell of boundary-overlapping points is
    thinnest is taken; both sides must get a fair share.
    """
    best = None
    for v in points[:: max(1, len(points) // 8)][:8]:
        d = distance(points, v)
        radius = int(np.median(d))
        for r in (radius, radius - 1):
            inside = int((d <= r).sum())
            if 0 < inside < len(points) and min(inside, len(points) - inside) * 5 >= len(points):
                shell = int((np.abs(d.astype(np.int64) - r) <= 2).sum())
                if best is None or shell < best[0]:
                    best = (shell, v, r)
    if best is None:
        for v in points[:64]:
            d = distance(points, v)
            if d.min() < d.max():
                return v, int((int(d.min()) + int(d.max()) - 1) // 2)
        return None
    return best[1], best[2]


class Router:
    """A vantage-point tree over a sample; its leaves are the shards."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.nodes: list[tuple] = []  # (vantage, radius, inside, outside), or (shard,)
        self.shards = 0
        self._grow(sample, shards)

    def _grow(self, points: np.ndarray, shards: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        cut = split_point(points) if shards > 1 and len(points) >= 8 else None
        if cut is None:
            self.nodes[at] = (self.shards,)
            self.shards += 1
            return at
        v, radius = cut
        inside = distance(points, v) <= radius
        share = min(shards - 1, max(1, round(shards * float(inside.mean()))))
        self.nodes[at] = (v, radius, self._grow(points[inside], share), self._grow(points[~inside], shards - share))
        return at

    def route(self, points: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) for every shard that may hold a point within ``slack``; 0: the home shard."""
        rows, shards, stack = [], [], [(0, np.arange(len(points)))]
        while stack:
            at, idx = stack.pop()
            node = self.nodes[at]
            if len(node) == 1:
                rows.append(idx)
                shards.append(np.full(len(idx), node[0]))
                continue
            v, radius, inside, outside = node
            d = distance(points[idx], v).astype(np.int64)
            # the triangle bound: a partner's distance to v differs by slack at most
            stack.append((inside, idx[d - slack <= radius]))
            stack.append((outside, idx[d + slack > radius]))
        return np.concatenate(rows), np.concatenate(shards)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that it reaches over the links (a, b)."""
    up = np.arange(n)
    while True:
        x, y = up[a], up[b]
        if (x == y).all():
            return up
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while not ((top := up[up]) == up).all():
            up = top


def links_within(members: np.ndarray, queries: np.ndarray, slack: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (query, member) indices at distance <= slack, by a vantage-point tree over the members."""
    stack = [(np.arange(len(members)), np.arange(len(queries)))]
    while stack:
        m, q = stack.pop()
        if not len(m) or not len(q):
            continue
        cut = split_point(members[m]) if len(m) > LEAF else None
        if cut is None:
            step = max(1, PAIRS // len(m))
            for i in range(0, len(q), step):
                part = q[i : i + step]
                x, y = np.nonzero(distance(queries[part][:, None], members[m][None, :]) <= slack)
                if len(x):
                    yield part[x], m[y]
            continue
        v, radius = cut
        dm, dq = distance(members[m], v), distance(queries[q], v).astype(np.int64)
        stack.append((m[dm <= radius], q[dq - slack <= radius]))
        stack.append((m[dm > radius], q[dq + slack > radius]))


def shard_links(fp: np.ndarray, home: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (node, root) of the links found in one shard.

    However many near copies a group has, a shard gives one row per point.
    """
    bits = fp.view(np.uint64)
    own = np.nonzero(home)[0]
    up, a, b, held = np.arange(len(fp)), [], [], 0
    for x, y in links_within(bits[own], bits, slack):
        y = own[y]
        keep = x != y
        a.append(x[keep])
        b.append(y[keep])
        held += len(a[-1])
        if held > PAIRS:
            up = forest(len(fp), np.concatenate([np.arange(len(fp)), *a]), np.concatenate([up, *b]))
            a, b, held = [], [], 0
    up = forest(len(fp), np.concatenate([np.arange(len(fp)), *a]), np.concatenate([up, *b]))
    linked = np.nonzero(up != np.arange(len(fp)))[0]
    return fp[linked], fp[up[linked]]


def near_links(distinct: DataFrame, slack: int = 2, shard_points: int = 20_000, sample_points: int = 200_000) -> DataFrame:
    """(a, b): a forest whose components are those of all pairs of ``fp`` at distance <= ``slack``.

    A tree over a sample (at most ``sample_points``, only to choose vantage
    points) parts the space into shards of about ``shard_points``. Each
    fingerprint lives in one shard and visits those whose boundary it overlaps,
    so that no pair is missed whatever the sample was. Inside a shard a second
    tree prunes by the same bound.
    """
    spark = distinct.sparkSession
    shards = parts(distinct.count(), shard_points)
    wanted = min(sample_points, 64 * shards)
    sample = [r[0] for r in distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(wanted).collect()]
    router = spark.sparkContext.broadcast(Router(np.array(sample, np.int64).view(np.uint64), shards))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = router.value
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            home = np.empty(len(fp), np.int64)
            row, shard = tree.route(fp.view(np.uint64), 0)
            home[row] = shard
            row, shard = tree.route(fp.view(np.uint64), slack)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), pa.array(fp[row]), pa.array(home[row] == shard)], names=["shard", "fp", "home"])

    def pairs(table: pa.Table) -> pa.Table:
        a, b = shard_links(table["fp"].to_numpy(), table["home"].to_numpy(), slack)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = distinct.select("fp").mapInArrow(deal, "shard bigint, fp bigint, home boolean")
    return dealt.groupBy("shard").applyInArrow(pairs, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, slack: int = 2, words: int = 3, shard_points: int = 20_000, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): groups of documents linked by near-equal SimHashes.

    Fingerprints link at ``slack`` or fewer differing bits; a component is all
    that links reach, and its id the smallest doc_id in it. Copies are reduced to
    one fingerprint before anything is compared.

    Null and blank texts have fingerprint 0 and link like any other. A null
    doc_id takes part and never names a component unless all of it are null.
    Repeated rows come out as often as they came in. Empty table: no rows. Other
    columns aren't looked at.
    """
    found = stored(fingerprints(docs, id, text, words), "simhash")
    distinct = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash_distinct")
    links = connected(near_links(distinct, slack, shard_points))
    named = distinct.join(links, distinct["fp"] == links["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = named.join(least, "root").select("fp", "component_id")
    return found.join(of, "fp").select("doc_id", "fp", "component_id")


def _describe(text: str | None, words: int, keys: int) -> tuple[int, bytes, int]:
    """SimHash of the word shingles, the ``keys`` least distinct shingle hashes, and how many shingles there are."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return 0, b"", 0
    return majority(hashes), np.unique(hashes)[:keys].tobytes(), len(hashes)


def copy_digest(text: Column) -> Column:
    """What copies have in common: a digest of the text without regard to case (A-Z) and blanks."""
    plain = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.md5(F.trim(F.regexp_replace(plain, r"[ \t\n\x0B\f\r]+", " ")))


def near_copies(
    docs: DataFrame,
    words: int = 5,
    similarity: float = 0.8,
    slack: int = 18,
    keys: int = 6,
    shard_points: int = 4000,
    shard_shingles: int = 4_000_000,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, component_id, digest, stays): documents linked by texts whose shingle sets have a Jaccard likeness of ``similarity``.

    ``digest`` is the text's ``copy_digest``; with the id it tells which row is
    meant. Of a component the text of the least id ``stays``, under that id.

    Texts that alike differ in up to ``slack`` of 64 SimHash bits, a radius at
    which balls around any vantage point overlap all shards of a tree over the
    whole table. So the space is parted by content first: a text visits a shard
    for each of its ``keys`` least shingle hashes (texts as like as this share one
    with a probability of over 1 - 0.2^6). Inside a shard a vantage-point tree
    finds all fingerprints within ``slack``; a spanning forest of them tells the
    groups outside of which nothing can be alike. A group then gets the shingles
    (as 32-bit hashes) of its whole texts, each once, and every pair within
    ``slack`` that isn't linked yet is checked on them: links are thinned to a
    forest only after they were checked.

    Copies are one text. All texts of a key of over ``shard_points`` are one
    group, so that no pair of them is missed. A group of over
    ``shard_points`` texts or ``shard_shingles`` shingles is dealt to parts; then
    each text outside the largest component that the parts hold together is
    sought in all other parts. Links are as many as texts and parts at most, never
    all pairs of a group.

    Null text is empty; texts without words are copies of one another. A null
    doc_id takes part and never names a component unless all of it are null.
    Different texts under one id are different documents. Repeated rows come out
    as often as they came in. Empty table: no rows. Other columns aren't looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_describe(t.as_py(), words, keys) for t in batch.column(1)]
            fp = np.array([f for f, _, _ in got], np.uint64).view(np.int64)
            low = [np.frombuffer(b, np.int64).tolist() for _, b, _ in got]
            size = pa.array([n for _, _, n in got], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp, pa.int64()), pa.array(low, pa.list_(pa.int64())), size], names=["doc_id", "digest", "fp", "keys", "size"])

    ids = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), copy_digest(F.col(text)).alias("digest"))
    found = stored(ids.mapInArrow(run, "doc_id bigint, digest string, fp bigint, keys array<bigint>, size bigint"), "copies")
    one = found.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min("fp").alias("fp"), F.min("keys").alias("keys"), F.min("size").alias("size"))
    distinct = stored(one.withColumn("node", F.monotonically_increasing_id()), "copies_distinct")  # numbers are settled once they are stored

    placed = distinct.select("node", "fp", F.explode("keys").alias("key"))
    shared = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("head")).filter("n > 1")
    own = placed.join(shared.filter(F.col("n") <= shard_points), "key").select("key", "node", "fp")
    # texts of a hot key are one group without a look at their fingerprints; each pair is compared there
    hubs = placed.join(shared.filter(F.col("n") > shard_points), "key").select(F.col("node").alias("a"), F.col("head").alias("b"))

    def links(table: pa.Table) -> pa.Table:
        node, fp = table["node"].to_numpy(), table["fp"].to_numpy().view(np.uint64)
        a, b = closest_forests(fp, slack, 1)
        return pa.table({"a": pa.array(node[a], pa.int64()), "b": pa.array(node[b], pa.int64())})

    near = own.groupBy("key").applyInArrow(links, "a bigint, b bigint")
    candidates = stored(near.union(hubs).filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "copies_candidates")

    groups = connected(candidates)
    members = distinct.join(groups, "node").select(F.col("root").alias("group"), F.col("node").alias("id"), "fp", "size", "first", F.col("digest").alias("text_digest"))
    members = stored(members, "copies_members")

    def in_parts(rows: DataFrame) -> DataFrame:
        # how many parts the rows of each group make
        return rows.groupBy("group").agg(F.greatest(F.ceil(F.count(F.lit(1)) / shard_points), F.ceil(F.sum("size") / shard_shingles)).alias("parts"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([np.unique(shingle_hashes(t.as_py(), words).astype(np.uint32)).view(np.int32) for t in batch.column(4)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], made], names=["group", "id", "fp", "part", "set"])

    placed = members.join(in_parts(members), "group").withColumn("part", F.pmod(F.xxhash64("id", "group"), F.col("parts")))
    whole = ids.join(placed, ids["doc_id"].eqNullSafe(placed["first"]) & (ids["digest"] == placed["text_digest"])).dropDuplicates(["id"]).select("group", "id", "fp", "part", "text")
    whole = stored(whole.mapInArrow(sets, "group bigint, id bigint, fp bigint, part bigint, set array<int>"), "copies_sets")

    def alike(table: pa.Table, across: bool = False) -> pa.Table:
        ids, lists = table["id"].to_numpy(), table["set"].combine_chunks()
        _, start, component = np.unique(table["component"].to_numpy(), return_index=True, return_inverse=True)
        home = table["home"].to_numpy()
        asks = ~home if across else home
        a, b = alike_forest(table["fp"].to_numpy().view(np.uint64), lists.flatten().to_numpy(), lists.value_lengths().to_numpy(), home, asks, start[component], slack, similarity)
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})

    sought = whole.select("group", "part", "id", "fp", "set", F.col("id").alias("component"), F.lit(True).alias("home"))
    good = stored(sought.groupBy("group", "part").applyInArrow(lambda t: alike(t), "a bigint, b bigint"), "copies_links")

    # groups of several parts: what isn't in the largest component so far is sought in the other parts
    hot = in_parts(members).filter("parts > 1")
    if not hot.isEmpty():
        linked = connected(good)
        rows = members.join(hot, "group").join(linked, members["id"] == linked["node"], "left").select("group", "parts", "id", "size", F.coalesce("root", "id").alias("component"))
        rows = stored(rows, "copies_hot")
        most = rows.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("group").agg(F.max_by("component", F.struct("n", "component")).alias("most"))
        rest = rows.join(most, "group").filter("component != most").select("group", "parts", "id", "size", "component")
        blocks = in_parts(rest).withColumnRenamed("parts", "blocks")
        near = whole.join(rows.select("id", "component"), "id").join(blocks, "group")
        near = near.select("group", "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), "id", "fp", "set", "component", F.lit(True).alias("home"))
        far = whole.join(rest.select("id", "parts", "component"), "id").join(blocks, "group")
        far = far.select("group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("to"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).alias("block"), "id", "fp", "set", "component", F.lit(False).alias("home"), "part")
        far = far.filter("to != part").drop("part").withColumnRenamed("to", "part").select(near.columns)
        across = near.union(far).groupBy("group", "part", "block").applyInArrow(lambda t: alike(t, across=True), "a bigint, b bigint")
        good = good.union(across)
    roots = connected(good)
    of = distinct.join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root"))
    least = of.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "digest")).alias("least"))
    of = of.join(least, "root").select("digest", F.col("least.first").alias("component_id"), (F.col("digest") == F.col("least.digest")).alias("kept"))
    stays = F.col("kept") & F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.join(of, "digest").select("doc_id", "component_id", "digest", stays.alias("stays"))


def alike_forest(
    fp: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, home: np.ndarray, asks: np.ndarray, up: np.ndarray, slack: int, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """A forest (node, root) of all pairs within ``slack`` whose sets have the Jaccard likeness, as indices.

    ``tokens`` holds the sets one after another, ``sizes`` how long each is. Of a
    pair one node ``asks`` and one is at ``home``. Nodes of one ``up`` are linked
    already; a pair is compared only while it isn't linked.
    """
    n, given = len(fp), up
    # tokens of one set alone are in no intersection
    _, own, times = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = times[own] > 1
    of = np.repeat(np.arange(n), sizes)[shared]
    own = own[shared]
    lengths = np.bincount(of, minlength=n)
    starts = np.cumsum(lengths) - lengths
    marked = np.zeros(len(times), bool)

    def intersections(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        both = np.zeros(len(x), np.int64)
        order = np.argsort(y, kind="stable")
        for pairs in np.split(order, np.nonzero(np.diff(y[order]))[0] + 1):
            one = own[starts[y[pairs[0]]] :][: lengths[y[pairs[0]]]]
            marked[one] = True
            ends = np.cumsum(lengths[x[pairs]])
            at = 0
            while at < len(pairs):  # a bounded number of tokens at once
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOKENS, "right")))
                part = x[pairs[at:to]]
                many = lengths[part]
                row = np.repeat(np.arange(len(part)), many)
                place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(starts[part], many)
                both[pairs[at:to]] = np.bincount(row[marked[own[place]]], minlength=len(part))
                at = to
            marked[one] = False
        return both

    at_home, asking = np.nonzero(home)[0], np.nonzero(asks)[0]
    for x, y in links_within(fp[at_home], fp[asking], slack):
        x, y = asking[x], at_home[y]
        keep = (up[x] != up[y]) & (~home[x] | (x < y)) & (np.minimum(sizes[x], sizes[y]) >= similarity * np.maximum(sizes[x], sizes[y]))
        x, y = x[keep], y[keep]
        order = np.argsort(distance(fp[x], fp[y]), kind="stable")
        x, y, step = x[order], y[order], 512
        while len(x):
            a, b = x[:step], y[:step]
            both = intersections(a, b)
            good = both >= similarity * (sizes[a] + sizes[b] - both)
            up = forest(n, np.concatenate([np.arange(n), a[good]]), np.concatenate([up, b[good]]))
            x, y, step = x[step:], y[step:], 2 * step
            keep = up[x] != up[y]
            x, y = x[keep], y[keep]
    linked = np.nonzero(up != given)[0]
    return linked, up[linked]


def closest_forests(fp: np.ndarray, slack: int, forests: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the fingerprints that takes the closest links first, then one of the links left, and so on; as pairs of indices.

    What a group of links holds together by so many separate ways is held
    together by the result as well, although that is linear in the group's size.
    """
    bits, to_one = np.unique(fp, return_inverse=True)
    order = np.argsort(to_one, kind="stable")
    one = order[np.searchsorted(to_one[order], np.arange(len(bits)))]  # an index of each
    rest = np.nonzero(one[to_one] != np.arange(len(fp)))[0]
    a, b = [rest], [one[to_one[rest]]]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def forest_of(x, y, d):
        # Kruskal's rule, a distance at a time
        up, kept = np.arange(len(bits)), []
        for step in range(slack + 1):
            at = np.nonzero(d == step)[0]
            while len(at := at[up[x[at]] != up[y[at]]]):
                hi, lo = np.maximum(up[x[at]], up[y[at]]), np.minimum(up[x[at]], up[y[at]])
                _, pick = np.unique(hi, return_index=True)  # each root hooks to one smaller root
                kept.append(at[pick])
                up[hi[pick]] = lo[pick]
                while not ((top := up[up]) == up).all():
                    up = top
        return np.concatenate(kept) if kept else np.zeros(0, np.int64)

    def reduced(parts):
        x, y, d = (np.concatenate(c) for c in zip(*parts))
        keep = np.zeros(len(x), bool)
        for _ in range(forests):
            left = np.nonzero(~keep)[0]
            keep[left[forest_of(x[left], y[left], d[left])]] = True
        return [(x[keep], y[keep], d[keep])]

    for q, m in links_within(bits, bits, slack):
        upper = q < m
        q, m = q[upper], m[upper]
        found.append((q, m, distance(bits[q], bits[m])))
        held += len(q)
        if held > PAIRS:
            found = reduced(found)
            held = len(found[0][0])
    if found:
        x, y, _ = reduced(found)[0]
        a.append(one[x])
        b.append(one[y])
    return np.concatenate(a), np.concatenate(b)
