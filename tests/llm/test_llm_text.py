"""Language ID, quality, decontamination, winnowing and licences on small inputs."""

import itertools
import math
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marketflow.llm import decontaminate, langid, licenses, quality, winnowing
from marketflow.llm.common import table

ODD = [(1, "Plain words here."), (2, None), (3, ""), (4, " \n\t"), (5, "123 !!"), (6, "word " * 30_000), (7, "x" * 120_000), (8, "\U0001f600\U0001f600 ü漢字かな"), (8, "\U0001f600\U0001f600 ü漢字かな"), (None, "no id")]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, very long, repeated rows, and columns whose names the operators use."""
    made = spark.createDataFrame(ODD, "doc_id bigint, text string").withColumn("lang", F.when(F.col("doc_id") < 6, "en"))
    return made.selectExpr("*", "'s' AS source", "1 AS n_chars", "1 AS score", "'a' AS row", "2 AS overlaps", "3 AS held_out", "4 AS key", "5 AS kind", "6 AS marks", "7 AS b", "8 AS guest", "9 AS bin", "0 AS line", "0 AS gone")


# language identification


def test_presence_is_the_set_of_hashed_grams():
    def grams(text):
        text = " " + "".join(c.lower() if c.isalpha() else " " for c in text) + " "
        text = re.sub(" +", " ", text)
        out = set()
        for n in langid.ORDERS:
            for i in range(len(text) - n + 1):
                h = 0
                for c in text[i : i + n]:
                    h = (h * 0x01000193 + (ord(c) + 1) * 0x9E3779B1) % 2**32
                out.add((h * 0x85EBCA6B % 2**32) >> 18)
        return out

    for t in ["", "a", "Ab c", "Straße, 12 ÉTÉ!!", "  x  ", "漢字 \U0001d54f"]:
        assert set(np.nonzero(langid.presence(t))[0].tolist()) == grams(t)
    rows = np.array([langid.presence(t) for t in ("abc abd", "abc xyz")])
    a, b = (set(np.nonzero(r)[0].tolist()) for r in rows)
    assert math.isclose(langid.kernel(rows, rows)[0, 1], len(a & b) / math.sqrt(len(a) * len(b)), rel_tol=1e-5)


def test_long_texts_are_marked_whole(monkeypatch):
    text = "".join(random.Random(1).choices("abcdeé ,X", k=5000))
    whole = langid.presence(text)
    monkeypatch.setattr(langid, "CHUNK", 64)
    assert (langid.presence(text) == whole).all()


def test_languages_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got[got.held_out].lang_pred == got[got.held_out].lang).mean() > 0.97


def test_language_of_odd_rows(spark, odd):
    got = langid.language_id(odd).toPandas()
    assert len(got) == len(ODD)
    assert set(got[got.doc_id.isin([2, 3, 4, 5])].lang_pred) == {"und"} and (got[got.lang_pred == "und"].score == 0).all()
    assert set(langid.language_id(odd.withColumn("lang", F.lit(None).cast("string"))).toPandas().lang_pred) == {"und"}
    assert langid.language_id(odd.limit(0)).count() == 0


# quality


def test_risk_is_non_negative_and_separates():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (300, 5)).astype(np.float32), rng.normal(-1, 1, (300, 5)).astype(np.float32)
    model = quality.fit(good[:150], np.concatenate([good[150:], bad[:80]]), 150 / 230)
    assert model.raw(good).mean() > 1 > -1 > model.raw(bad).mean()
    fair = quality.calibrate(model, np.concatenate([good, bad]), np.repeat([1.0, 0.0], 300), np.full(600, 1 / 600))
    s = fair.scores(np.concatenate([good, bad]))
    assert abs(s.mean() - 0.5) < 0.02 and (s[:300] > 0.5).mean() > 0.95


def test_features_of_pieces_equal_those_of_the_whole(monkeypatch):
    text = "Ab, cd cd\n" * 300 + "EF!! 12\n"
    whole = quality.features(text)
    monkeypatch.setattr(quality, "CHUNK", 50)
    assert np.allclose(quality.features(text), whole)


def test_quality_held_out(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = quality.quality(docs, labels).join(labels, "doc_id").toPandas()
    own = got[got.held_out]
    rank = own.score.rank()
    n1, n0 = (own.quality == 1).sum(), (own.quality == 0).sum()
    assert n0 > 5 and (rank[own.quality == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.95


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 0, 0), (6, 1, 0), (6, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.filter("quality = 1"), labels.limit(0)):
        got = quality.quality(odd, some).toPandas()
        assert len(got) == len(ODD) and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert quality.quality(odd.limit(0), labels).count() == 0


# decontamination


def plain_overlaps(text, item, least=13, share=0.8):
    d, own = re.findall(r"\w+", (text or "").lower()), re.findall(r"\w+", item.lower())
    need = min(least, len(own))
    if len(own) < decontaminate.LEAST_TOKENS:
        return False
    for shift in range(-len(own), len(d)):
        pairs = [d[shift + i] == w if 0 <= shift + i < len(d) else None for i, w in enumerate(own)]
        for i in range(len(own) - need + 1):
            part = pairs[i : i + need]
            if None not in part and sum(part) >= math.ceil(share * need):
                return True
    return False


def test_overlaps_against_a_plain_search(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 5, 9, 13, 30, 60])))) for i in range(40)]
    items += [(100, items[-1][1].upper()), (101, None), (None, "w1 w2 w3 w4")]
    rows = []
    for n in range(200):
        text = rng.choices(words, k=60)
        if n % 2:
            own = (rng.choice(items[:40])[1]).split()
            if n % 3 == 0:  # a substitution here and there
                own = [("zz" if k % 8 == 5 else w) for k, w in enumerate(own)]
            at = rng.randrange(60)
            text[at:at] = own
        rows.append((n, ", ".join(text)))
    rows += [(900, None), (901, ""), (902, rows[1][1]), (902, rows[1][1])]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = {(d, i) for d, t in rows for i, x in items if i is not None and x and plain_overlaps(t, x) and i != 100}
    for size in (4 << 20, 700):  # in one block, in several
        got = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, block_bytes=size).collect()]
        found = {(d, 39 if i == 100 else i) for d, i in got}
        assert found <= want and len(want - found) <= 0.1 * len(want) and len(want) > 80
    kept = decontaminate.clean(docs.selectExpr("*", "1 AS overlaps", "2 AS row", "3 AS __x"), bench)
    assert kept.columns == ["doc_id", "text", "overlaps", "row", "__x"]
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in found}
    assert decontaminate.clean(docs.limit(0), bench).count() == 0 and decontaminate.clean(docs, bench.limit(0)).count() == len(rows)


@pytest.mark.parametrize("n", range(3, 15))
def test_every_admitted_pattern_is_found(n):
    own, need = [f"w{i}" for i in range(n)], min(13, n)
    block = decontaminate.Block([(7, "before the item"), (1, " ".join(own)), (8, "w1 after it")], 13, 0.8)
    for misses in range(4):
        for at in itertools.combinations(range(n), misses):
            text = "x w3 y " + " ".join("zz" if i in at else w for i, w in enumerate(own)) + " w0 x"
            got = [o for o in block.overlaps(text) if o["item_id"] == 1]
            assert bool(got) == plain_overlaps(text, " ".join(own)), at
            if got and n <= 13:
                assert got == [{"item_id": 1, "doc_start": 3, "length": need, "matched": n - misses}]


def test_words_of_pieces_equal_those_of_the_whole(monkeypatch):
    text = "one two_three, four5 " * 50
    whole = [w for ws in decontaminate.words(text) for w in ws]
    monkeypatch.setattr(decontaminate, "CHUNK", 7)
    assert [w for ws in decontaminate.words(text) for w in ws] == whole


def test_decontamination_of_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, "word word word word word word word word")], "item_id bigint, text string")
    assert [r.doc_id for r in decontaminate.contaminated(odd, bench).collect()] == [6]
    kept = decontaminate.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1


# winnowing


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def pair(a, b):
    return signed(xxhash.xxh64_intdigest(struct.pack("<q", b), xxhash.xxh64_intdigest(struct.pack("<q", a), 42)))


def plain_marks(text):
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^\W_]+", text.lower())]
    if len(h) >= 4:
        two = [pair(a, b) for a, b in zip(h, h[1:])]
        h = [pair(a, b) for a, b in zip(two, two[2:])]
    elif h:
        seed = 42
        for x in h:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
        h = [seed]
    h = [x & (2**31 - 1) for x in h]
    windows = [range(i, i + 4) for i in range(len(h) - 3)] or ([range(len(h))] if h else [])
    return sorted({min((h[i], -i) for i in w) for w in windows})


def test_marks_equal_a_plain_loop(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcdefg", k=k)) for k in [0, 1, 2, 3, 4, 5, 6, 7, 8, 20, 300]] + ["a a a a a a a a a a", "É, été!"]
    got = winnowing.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    for r in got:
        assert sorted((m.hash, -m.position) for m in r.marks) == plain_marks(texts[r.doc_id])


def test_shared_passages_share_a_hash(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(7))
    rows = [(i, " ".join(rng.choices("abcdefghij", k=rng.randrange(30))) + " " + passage + " " + " ".join(rng.choices("klmnop", k=9))) for i in range(40)]
    got = [{m.hash for m in r.marks} for r in winnowing.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert all(a & b for a in got for b in got)


def test_unspaced_scripts_have_tokens(spark):
    got = winnowing.fingerprints(spark.createDataFrame([(1, "漢字漢字かなabc 12ไทย")], "doc_id bigint, text string")).first()
    assert max(m.position for m in got.marks) >= 4  # eleven tokens, not three


@pytest.mark.parametrize("size", [1, 8 << 20])
def test_neighbours(spark, size):
    rng = random.Random(7)
    rows = [(rng.randrange(-50, 500) * 7, " ".join(rng.choices(["ab", "ü", "\U0001f600", "xyz"], k=rng.randrange(12)))) for _ in range(150)]
    rows = list({i: (i, t) for i, t in rows}.values()) + [(9001, None), (9002, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    if size == 1:
        paired = winnowing.with_next(docs, lambda df: df, bucket_bytes=16)
        texts = sorted((i, t or "") for i, t in rows)
        assert sorted((r.doc_id, r.text, r.next_text) for r in paired.collect()) == [(i, t, texts[(k + 1) % len(texts)][1]) for k, (i, t) in enumerate(texts)]
    got = {r.doc_id: r for r in winnowing.neighbours(docs).collect()}
    texts = sorted((i, t or "") for i, t in rows)
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[i]
        assert (r.n_chars, r.edited) == (len(t), edited)
        a, b, c = ({h for h, _ in plain_marks(x)} for x in (t, edited, after))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert math.isclose(r.near_edited, like(a, b)) and math.isclose(r.near_next, like(a, c))


def test_neighbours_of_odd_rows(spark, odd):
    got = winnowing.neighbours(odd).collect()
    assert len(got) == len(ODD) and sum(r.doc_id is None for r in got) == 1
    assert winnowing.neighbours(odd.limit(0)).count() == 0
    one = winnowing.neighbours(odd.filter("doc_id = 1")).first()
    assert one.near_next == 1.0


# licences

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
"""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
THREE = "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
ASIS = '\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.\n'


def test_licences(spark):
    rows = [
        (1, "Text.\n" + MIT),
        (2, BSD + ASIS),
        (3, BSD + THREE + ASIS),
        (4, "first line\nLicensed under CC BY-NC 4.0.\nlast"),
        (5, "Hello. Released under the MIT License. Also: SPDX.\n// SPDX-License-Identifier: Apache-2.0\n"),
        (6, "the software is fine, no licence here"),
        (7, MIT.replace("The above copyright notice", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.\n\nThe above copyright notice")),
        (8, None),
        (9, ""),
    ]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.first_sentence, r.n_sentences)
    assert {i: set(x) for i, x in got.items()} == {1: {"MIT"}, 2: {"BSD-2-Clause"}, 3: {"BSD-3-Clause"}, 4: {"CC-BY-NC-4.0"}, 5: {"MIT", "Apache-2.0"}}
    assert got[1]["MIT"][1] == 3 and got[4]["CC-BY-NC-4.0"] == (1, 1)


def test_every_known_sentence_has_a_hint():
    ids, rules = licenses.known()
    assert all(re.search(licenses.HINT, s) and s == re.sub("[^a-z0-9]+", " ", s).strip() for s in ids)
    assert all(i in set(ids.values()) for _, rule in rules for i in rule) and len(set(ids.values())) == len(ids)


def test_licences_of_odd_rows(spark, odd):
    assert licenses.scan(odd).count() == 0 and licenses.scan(odd.limit(0)).count() == 0
