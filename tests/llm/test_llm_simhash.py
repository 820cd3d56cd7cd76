"""SimHash groups against a plain double loop."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marketflow.llm.components import connected
from marketflow.llm.simhash import Router, alike_forest, closest_forests, copy_digest, fingerprint, forest, links_within, near_copies, near_duplicates


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(points, slack):
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p in points:
        for q in points:
            if (p ^ q).bit_count() <= slack:
                a, b = sorted((find(p), find(q)))
                root[b] = a
    return {p: find(p) for p in points}


def clustered(rng, n):
    base = rng.integers(0, 2**63, n // 4, dtype=np.uint64)
    out = set(base.tolist())
    for b in base.tolist():
        for _ in range(5):
            for _ in range(rng.integers(1, 4)):
                b ^= 1 << int(rng.integers(0, 64))
            out.add(b)
    return np.array(sorted(out), np.uint64)


def test_fingerprint():
    for t in ["", None, " \t\n", "One", "One TWO", "a b c", "É é É x y Z z", "the the the the the", "w " * 999 + "v"]:
        assert fingerprint(t) == plain(t)


@pytest.mark.parametrize("slack", [0, 2, 5])
def test_tree_finds_every_pair(slack):
    points = clustered(np.random.default_rng(slack), 900)
    d = np.bitwise_count(points[:, None] ^ points[None, :])
    want = set(zip(*(x.tolist() for x in np.nonzero(d <= slack))))
    got = set()
    for q, m in links_within(points, points, slack):
        got |= set(zip(q.tolist(), m.tolist()))
    assert got == want
    tree = Router(points[::7], 9)
    home = dict(zip(*(x.tolist() for x in tree.route(points, 0))))
    seen = set(zip(*(x.tolist() for x in tree.route(points, slack))))
    assert len(home) == len(points) and tree.shards > 1
    assert all((q, home[m]) in seen for q, m in want)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (2, 1), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(51)) and all(got[i] == 1000 for i in range(1000, 1100)) and got[2001] == 2000
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_groups_equal_a_double_loop(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        text = list(rng.choice(words, 300))
        rows.append((3 * i + 500, " ".join(text)))
        for k in range(2):
            text[int(rng.integers(0, 300))] = "changed"
            rows.append((3 * i + 501 + k, " ".join(text)))
    rows += [(10_000 + i, rows[0][1]) for i in range(50)] + [(7, None), (8, ""), (9, " "), (None, "alone here"), (5, "x y z"), (5, "x y z"), (4, "X y\tz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS fp", "2 AS root", "3 AS component_id")
    got = near_duplicates(docs, shard_points=40).collect()
    assert len(got) == len(rows)
    bits = {t: plain(t) for _, t in rows}
    root = roots(sorted(set(bits.values())), 2)
    least = {}
    for i, t in rows:
        if i is not None:
            r = root[bits[t]]
            least[r] = min(i, least.get(r, i))
    want = sorted(((i, bits[t], least.get(root[bits[t]])) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == want


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def jaccard_roots(texts, similarity=0.8):
    sets = {}
    for t in texts:
        w = (t or "").lower().split()
        sets[t] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    links = []
    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                links.append((a, b))
    return keys, links


def test_closest_forest_spans_what_the_links_span():
    points = clustered(np.random.default_rng(3), 400)
    points = np.concatenate([points, points[:30]])
    a, b = closest_forests(points, 9, 1)
    d = np.bitwise_count(points[:, None] ^ points[None, :])
    x, y = np.nonzero(d <= 9)
    assert (forest(len(points), a, b) == forest(len(points), x, y)).all()
    assert len(a) == len(points) - len(set(forest(len(points), a, b).tolist()))
    more = closest_forests(points, 9, 3)
    assert len(a) < len(more[0]) <= 3 * len(points)


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    rng = random.Random(3)
    a, b = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(80)) for _ in range(2))
    rows = [(3, b), (8, a), (8, b), (9, a + " q"), (None, a), (None, "text of no id and no copies at all")]
    got = {(r.doc_id, r.digest): (r.component_id, r.stays) for r in near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    of = {t: r.d for t, r in zip([a, b, a + " q", rows[-1][1]], spark.createDataFrame([(i, t) for i, t in enumerate([a, b, a + " q", rows[-1][1]])], "i int, t string").select("i", copy_digest(F.col("t")).alias("d")).orderBy("i").collect())}
    assert got[3, of[b]] == (3, True) and got[8, of[b]] == (3, False)
    assert got[8, of[a]] == (8, True) and got[9, of[a + " q"]] == (8, False) and got[None, of[a]] == (8, False)
    assert got[None, of[rows[-1][1]]] == (None, True)


def test_near_copies_equal_a_double_loop(spark):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(900)]
    lead = " ".join(rng.choice(words, 12))  # in many texts
    rows = []
    for i in range(40):
        text = list(rng.choice(words, int(rng.integers(20, 400))))
        rows.append((10 * i, lead + " " + " ".join(text)))
        for k in range(int(rng.integers(0, 4))):
            other = list(text)
            for _ in range(max(1, len(text) // 60)):
                other[int(rng.integers(0, len(text)))] = "zz"
            rows.append((10 * i + 1 + k, lead + " " + " ".join(other)))
    rows += [(5000, rows[0][1]), (5001, rows[0][1].upper()), (6000, None), (6001, ""), (6002, " "), (6003, "one two"), (6004, "one  two")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS digest", "2 AS keys", "3 AS id")
    got = {r.doc_id: r.component_id for r in near_copies(docs, shard_points=30).collect()}
    texts = sorted({" ".join((t or "").lower().split()) for _, t in rows})
    keys, links = jaccard_roots(texts)
    root = {t: t for t in keys}
    for _ in range(len(keys)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    least = {}
    for i, t in rows:
        r = root[" ".join((t or "").lower().split())]
        least[r] = min(i, least.get(r, i))
    want = {i: least[root[" ".join((t or "").lower().split())]] for i, t in rows}
    wrong = {i for i in want if want[i] != got[i]}
    assert len(wrong) <= 0.02 * len(rows), wrong
    assert near_copies(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def edits(rng, n, size, swaps):
    """A text of distinct words and n edits of it, each with some words of its own."""
    core = [f"c{i}" for i in range(size)]
    out = [" ".join(core)]
    for k in range(n):
        text = list(core)
        for j, at in enumerate(rng.choice(size, swaps, replace=False)):
            text[at] = f"e{k}x{j}"
        out.append(" ".join(text))
    return out


def same_groups(got, want):
    assert {tuple(sorted(x)) for x in got.values()} == {tuple(sorted(x)) for x in want.values()}


def groups_of(spark, rows, **options):
    out = {}
    for r in near_copies(spark.createDataFrame(rows, "doc_id bigint, text string"), **options).collect():
        out.setdefault(r.component_id, []).append(r.doc_id)
    return out


def plain_groups(rows):
    keys, links = jaccard_roots([t for _, t in rows])
    root = {t: t for t in keys}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    out = {}
    for i, t in rows:
        out.setdefault(find(t), []).append(i)
    return out


@pytest.mark.parametrize("across", [False, True])
def test_every_alike_pair_is_linked(across):
    rng = np.random.default_rng(8)
    sets = [np.sort(rng.choice(60, int(rng.integers(5, 30)), replace=False)) for _ in range(150)]
    sets += [np.delete(s, rng.integers(0, len(s))) for s in sets for _ in range(2)]
    n = len(sets)
    fp = rng.integers(0, 2**63, n, dtype=np.uint64)
    home = rng.random(n) < 0.5 if across else np.ones(n, bool)
    asks = ~home if across else home
    a, b = alike_forest(fp, np.concatenate(sets).astype(np.int32), np.array([len(s) for s in sets]), home, asks, np.arange(n), 40, 0.8)
    near = [(i, j) for i in range(n) for j in range(n) if asks[i] and home[j] and (int(fp[i]) ^ int(fp[j])).bit_count() <= 40]
    true = [(i, j) for i, j in near if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    x, y = np.array(true).T
    assert len(a) < n and (forest(n, a, b) == forest(n, x, y)).all() and len(true) >= len(a) > 0


def test_an_original_holds_its_edits_together(spark):
    rows = [(i, t) for i, t in enumerate(edits(np.random.default_rng(2), 200, 100, 2))]
    same_groups(groups_of(spark, rows), plain_groups(rows))
    assert len(plain_groups(rows)) == 1


def test_a_group_in_parts_keeps_its_links(spark):
    rng = np.random.default_rng(4)
    rows = [(100 * f + i, t) for f in range(3) for i, t in enumerate(edits(rng, 60, 100, 2)[::-1])]
    rows = [(i, t if i < 100 else " ".join(f"f{i // 100}{w}" for w in t.split())) for i, t in rows]
    same_groups(groups_of(spark, rows, shard_shingles=2000), plain_groups(rows))


def test_a_hot_key_keeps_all_links(spark):
    # the least id is an edit, and every key is shared by more texts than a shard holds
    lead = " ".join(f"l{i}" for i in range(400))
    texts = edits(np.random.default_rng(6), 60, 100, 2)
    rows = [(i, t) for i, t in enumerate(texts[1:] + texts[:1])] + [(1000 + i, f"{lead} {' '.join(f'o{i}x{j}' for j in range(150 + i))}") for i in range(20)]
    want = plain_groups(rows)
    assert sorted(map(len, want.values())) == [1] * 20 + [61]
    same_groups(groups_of(spark, rows, shard_points=8), want)
