"""The filter audit against plain loops, and its sketch."""

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from marketflow.llm import audit
from marketflow.llm.common import stored

SCHEMA = "doc_id bigint, text string, lang string, part string, h int"


def plain(docs, labels):
    rows, out = [], []
    texts = {}
    for id, text, *_ in docs:
        if id is not None:
            texts[text or ""] = min(id, texts.get(text or "", id))
    for id, text, lang, *_ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": id is not None and id > texts[t],
        }
        mark = [q for i, *q in labels if i == id and id is not None]
        rows.append((lang or "", fails, any(q[0] == 1 for q in mark), any(q[1] == 1 for q in mark)))
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = own
            for i, x in enumerate(order):
                gone = [r for r in left if r[0][x]]
                before = [r for r in own if r[0][x] and not any(r is g for g in left)]
                left = [r for r in left if not r[0][x]]
                total[x] += len(gone)
                only = sum(r[0][x] and sum(r[0].values()) == 1 for r in own)
                lines.append((part, "".join(order), i + 1, len(left), len(gone), len(before), only, sum(r[1] for r in gone), sum(r[2] for r in gone), x))
        out += [(*line[:-1], total[line[-1]]) for line in lines]
    return sorted(out)


def cases():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(150)]
    clean = " ".join(words)
    rows = [(1, None, None), (2, "", "en"), (3, "", "en"), (3, "", "de"), (None, "", "en"), (None, clean, ""), (4, clean, "en"), (5, clean, "de"), (4, clean, "en"), (6, clean + " a|b", "en")]
    rows += [(7, " ".join(["Same"] * 200), "en"), (8, clean.upper(), "de"), (9, "\x1f".join(words), "en"), (10, " ".join(words), "en"), (11, "\x0b".join(words), "en")]
    rows += [(20 + i, rng.choice([clean, "A B C", "x # y", " ".join(words[: rng.randint(95, 105)])]), rng.choice(["en", "de"])) for i in range(60)]
    rows += [(4, "other text of id four", "en"), (12, "other text of id four", "en")]
    docs = [(*r, "clash", 7) for r in rows]
    labels = [(4, 1, 0), (4, 0, 1), (5, 1, None), (7, 0, 1), (8, None, 1), (None, 1, 1), (99, 1, 1)] + [(20 + i, i % 2, (i // 2) % 2) for i in range(60)]
    return docs, labels


def test_audit_equals_plain_loops(spark):
    docs, labels = cases()
    got = audit.audit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert sorted(map(tuple, got.collect())) == plain(docs, labels)


def test_a_full_sketch_changes_nothing(spark):
    docs, _ = cases()
    df = spark.createDataFrame(docs, SCHEMA)
    total = lambda m: sorted(map(tuple, m.groupBy("part", "mask").agg(F.sum("n")).collect()))
    assert total(audit.masks(df, most_segments=1)) == total(audit.masks(df))


def test_sketch_clears_only_unique_texts_and_most_of_them(spark):
    h = spark.range(20_000).select(F.xxhash64("id").alias("h")).union(spark.range(500).select(F.xxhash64("id").alias("h")))
    twice, segments = audit.sketch(h, 20_500, 1 << 17)
    assert segments == -(-20_500 * audit.SLOTS // audit.SEGMENT)
    found = audit.may_repeat(h, stored(twice, "sketch"), segments).groupBy("h", "suspect").count().collect()
    assert all(r.suspect for r in found if r["count"] > 1)
    kept = sum(r.suspect for r in found if r["count"] == 1)
    assert kept < 0.08 * 19_500


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "x", "en", "p", 1)], SCHEMA)
    assert audit.audit(one, labels).count() == 600
