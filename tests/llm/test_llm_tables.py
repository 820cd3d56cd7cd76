"""Chat formatting, line dedup, sharding and the pipeline; queries against SQL."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import plan
from marketflow.llm import chat, linededup, queries, sharding
from marketflow.llm.common import stored, table
from verification.compare import compare, tables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(queries.REGISTRY[name](spark, SF), tables(SF).execute(queries.ORACLES[name])) == ""


@pytest.mark.parametrize("name", ["op4_licenses", "op5_fingerprints", "op7_chat", "op8_line_dedup"])
def test_native_queries_run_no_python(spark, name):
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan(queries.REGISTRY[name](spark, SF)))


# chat


def plain_chat(turns):
    esc = lambda t: t.replace("\\", "\\\\").replace("<|", "<\\|")
    out, last = "", None
    for role, text in turns:
        if role != last:
            out += ("<|im_end|>\n" if out else "") + "<|im_start|>" + esc(role).replace("\n", "\\\n") + "\n"
        else:
            out += "<|im_sep|>"
        out += esc(text)
        last = role
    return out + "<|im_end|>\n"


def test_chats_come_back(spark):
    rng = random.Random(1)
    bits = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "\\", "<", "|", ">", "\n", "a", "é", "\U0001f600", "<\\|", "user", "$1", ""]
    said = lambda: "".join(rng.choices(bits, k=rng.randrange(9)))
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "sys\ntem", "a\\b", "<|x", None]), said() if rng.random() < 0.9 else None))
    rows += [(None, 1, "user", "x"), (100, None, "user", "late"), (100, 1, "assistant", None), (101, 0, "user", "same"), (101, 0, "user", "same"), (102, 0, "assistant", "z" * 200_000)]
    docs = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS t", "2 AS first", "3 AS segments")
    made = chat.format_chats(docs)
    got = {r.conv_id: r for r in made.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_spans(F.col("segments")).alias("spans")).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append(((t is not None, t or 0), role or "", text or ""))
    assert set(got) == set(by)
    unescape = lambda t: re.sub(r"\\(.)", r"\1", t, flags=re.S)
    for c, turns in by.items():
        want, r = [(role, text) for _, role, text in sorted(turns)], got[c]
        assert r.formatted == plain_chat(want)
        assert [(x.role, x.text) for x in r.turns] == want
        assert [unescape(r.formatted[s.start : s.start + s.length]) for s in r.spans] == [t for role, t in want if role == "assistant"]
        assert "".join(s.text for s in r.segments) == r.formatted
    assert chat.format_chats(docs.limit(0)).count() == 0


def test_extra_conversation_is_in_the_query(spark):
    got = queries.op7_chat(spark, SF).filter("conv_id = -1").first()
    said = queries.SAID
    assert got.n_turns == 2 and got.loss_chars == len(said)
    assert got.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


# line dedup


def lines_of(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS row", "1 AS doc", "2 AS gone", "3 AS key", "length(text) AS n_chars")
    out = linededup.clean(docs, **options)
    assert out.columns == docs.columns
    return {r.doc_id: r for r in out.collect()}


def test_recurring_lines_go_but_for_the_first(spark):
    own = lambda i, k: " ".join(random.Random(100 * i + k).choices([a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in "xyzwvq"], k=9)) + "h" * (i % 10 + k)
    foot = "Posted by someone on the board, reply to thread {} now please"
    passage = " ".join(f"p{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(i, f"{own(i, 1)}\n{foot.format(i * 17)}\n{own(i, 2)}\nShort one.\n") for i in range(1, 8)]
    rows += [(20, own(20, 1) + "\n" + passage + "\n" + own(20, 2)), (21, own(21, 1) + "\n" + passage), (22, own(22, 9))]
    copy = "\n".join(own(50, k) for k in range(6))
    rows += [(60 + i, copy) for i in range(9)] + [(90, None), (91, ""), (92, "\n\n"), (93, passage), (None, own(1, 1) + "\n" + foot.format(9))]
    got = lines_of(spark, rows)
    text = dict(rows)
    assert got[1].text == text[1]
    for i in range(2, 8):
        assert got[i].text == f"{own(i, 1)}\n{own(i, 2)}\nShort one.\n" and got[i].n_chars == len(got[i].text)
    assert got[20].text == text[20] and got[21].text == own(21, 1)
    assert all(got[i].text == text[i] for i in [22, 90, 91, 92, None, *range(60, 69)])
    assert got[93].text == ""  # only the passage, which another document keeps
    assert lines_of(spark, [], min_docs=2) == {}


def test_a_variable_field_may_vary(spark):
    frame = "we ask all members of this list to write {} before they leave the main hall today"
    rows = [(i, f"{'abcdefgh'[i] * (i + 8)} stands alone here\n" + frame.format(w)) for i, w in enumerate(["anna", "bert", "carl", "dora", "emil", "fritz"])]
    got = lines_of(spark, rows)
    assert all("we ask" not in got[i].text for i in range(1, 6)) and "we ask" in got[0].text


def distinct_lines(i, n=4):
    """Lines that no other document has."""
    rng = random.Random(1000 + i)
    return ["".join(rng.choices("bdfgklmnprst", k=rng.randrange(3, 9))) + " " + " ".join("".join(rng.choices("aeioubdgkls", k=rng.randrange(3, 12))) for _ in range(9)) for _ in range(n)]


def test_a_group_of_copies_shields_no_passage(spark):
    passage = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(55))
    rows = [(i, "\n".join([*distinct_lines(i), passage])) for i in range(40)]
    rows += [(1000 + i, "\n".join([*distinct_lines(999), passage])) for i in range(400)]
    got = lines_of(spark, rows)
    assert got[0].text == rows[0][1]
    assert all(got[i].text == "\n".join(distinct_lines(i)) for i in range(1, 40))
    assert all(got[1000 + i].text == "\n".join(distinct_lines(999)) for i in range(400))


def test_copies_of_the_first_keep_what_it_keeps(spark):
    foot = "this board is kept by its members since long ago"
    rows = [(i, "\n".join([*distinct_lines(0), foot])) for i in range(5)] + [(10 + i, "\n".join([*distinct_lines(10 + i), foot])) for i in range(6)]
    got = lines_of(spark, rows)
    assert all(got[i].text == rows[0][1] for i in range(5)) and all(foot not in got[10 + i].text for i in range(6))


def test_near_copies_keep_their_lines(spark):
    lines = distinct_lines(1, 12)
    rows = [(i, "\n".join(line if k != i % 12 else line.replace(line.split()[5], f"edit{chr(97 + i // 26)}{chr(97 + i % 26)}", 1) for k, line in enumerate(lines))) for i in range(60)]
    got = lines_of(spark, rows)
    assert all(got[i].text == text for i, text in rows)


def test_lines_of_a_block_do_not_hide_one_another(spark):
    block = ["all pages of this site are", "maintained at incomprehensibilitiesandmore.example.org/longest", "by people who like it a lot"]
    rows = [(i, "\n".join([*distinct_lines(i), *block])) for i in range(30)]
    got = lines_of(spark, rows)
    assert got[0].text == rows[0][1] and all(got[i].text == "\n".join(distinct_lines(i)) for i in range(1, 30))


def test_unspaced_scripts_and_short_lines_recur(spark):
    foot, short = "本网站的所有内容均由会员提供转载时请注明出处并保留原文链接谢谢", "Subscribe immediately"
    rows = [(i, "\n".join([*distinct_lines(i), foot, short, "ok"])) for i in range(8)]
    got = lines_of(spark, rows)
    assert got[0].text == rows[0][1] and all(got[i].text == "\n".join([*distinct_lines(i), "ok"]) for i in range(1, 8))


def test_texts_that_share_an_id_are_judged_apart(spark):
    foot = "this board is kept by its members since long ago"
    rows = [(i, "\n".join([foot, *distinct_lines(i)])) for i in range(6)] + [(5, "\n".join(distinct_lines(50)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(r.text for r in linededup.clean(docs).filter("doc_id = 5").collect())
    assert got == sorted(["\n".join(distinct_lines(5)), "\n".join(distinct_lines(50))])


# sharding


def check_shards(got, sizes, shards, share):
    assert sorted(got.shard.unique()) == list(range(shards))
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    weight = got.groupby("shard")["size"].sum()
    assert weight.max() <= share * weight.mean() and weight.min() >= weight.mean() / share


def test_shards_are_even_and_keep_copies_together(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abé ", k=rng.randrange(1, 400))) for _ in range(4000)]
    rows = list(enumerate(texts)) + [(10_000 + i, texts[i % 50]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS shard", "2 AS slot", "3 AS tie")
    got = sharding.shard(docs, shards=7).toPandas().merge(pd.DataFrame(rows, columns=["doc_id", "text"]), on="doc_id")
    assert len(got) == len(rows) and (got["size"] == [len(t.encode()) + 8 for t in got.text]).all()
    check_shards(got, None, 7, 1.05)
    assert (got.groupby("text").shard.nunique() == 1).all()


def test_a_third_of_all_rows_in_one_group(spark):
    rows = [(i, "the same text for all of them" if i % 3 == 0 else f"text {i} " + "x" * (i % 90)) for i in range(6000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=24).toPandas()
    check_shards(got, None, 24, 1.06)


def test_small_and_odd_tables(spark):
    schema = "doc_id bigint, text string"
    assert sharding.shard(spark.createDataFrame([], schema), shards=24).count() == 0
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (3, "y" * 100_000)]
    got = sharding.shard(spark.createDataFrame(rows, schema), shards=24).toPandas()
    assert len(got) == 5 and got.shard.between(0, 23).all()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    few = sharding.shard(spark.createDataFrame(rows, schema), target_bytes=1 << 30).toPandas()
    assert set(few.shard) == {0}


# the pipeline


def test_stages(spark):
    docs = table(spark, SF, "documents")
    more = [(10_000, None), (10_001, ""), (10_002, "12 34"), (10_003, "Word " * 20_000)]
    first = docs.filter("length(text) > 300").first()
    more += [(10_004, first.text), (10_005, first.text), (10_006, first.text + " end")]
    bench = table(spark, SF, "benchmark").first().text
    more += [(10_007, f"{docs.filter('lang = \"en\"').first().text[:200]} {bench}")]
    extra = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in more], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    now = docs.unionByName(extra).withColumn("row", F.lit(1)).withColumn("key", F.lit(2))
    before = now.columns
    gone = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, now, SF), f"test_{name}")
        if name != "packing":
            assert out.columns == before
            gone[name] = {r.doc_id for r in now.select("doc_id").collect()} - {r.doc_id for r in out.select("doc_id").collect()}
        else:
            texts = now.toPandas()
            assert set(out.toPandas().doc_id) == set(texts.doc_id)
        now = out
    assert {10_000, 10_001, 10_002} <= gone["language"] and len(gone["language"]) < 10
    assert gone["line_dedup"] == set()
    assert {10_004, 10_005, 10_006} <= gone["near_duplicates"] and first.doc_id not in gone["near_duplicates"]
    assert 10_007 in gone["decontamination"]
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SF), "test_empty")
        assert empty.count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    a, b = (" ".join(x for k in range(3) for x in distinct_lines(2000 + i, 3)) for i in range(2))
    rows = [(3, b), (8, a), (8, b), (9, a + " q"), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS digest", "2 AS stays", "3 AS __gone1")
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text) for r in out.collect()} == {(3, b), (8, a), (None, a)}


def test_run_gives_the_stages_rows(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert Counter(got.columns)["sequence_id"] == 1 and len(got) and (got.groupby("sequence_id")["length"].sum() <= 1024).all()
    assert np.isin(got.sequence_tokens, range(1, 1025)).all()
