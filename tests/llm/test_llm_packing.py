"""Packing: every id in one piece, exact ids, tight windows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketflow.llm.packing import OpenWindows, best_fit_decreasing, encoder, pack

NAME = "byte_bpe_50k.json"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_ids_equal_the_tokenizer(texts):
    tok = Tokenizer.from_file(public_tokenizers.path(NAME))
    for t in [*texts, "a  b\n\n c\t 'll 12ab <|endoftext|> é½²x_y"]:
        assert list(encoder(NAME).encode(t)) == tok.encode(t, add_special_tokens=False).ids


def test_ids_equal_the_tokenizer_for_every_code_point():
    tok = Tokenizer.from_file(public_tokenizers.path(NAME))
    assert encoder(NAME).ranks is not None
    for low in range(0, 0x110000, 256):
        if not 0xD800 <= low < 0xE000:
            text = "\n".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}" for c in range(low, low + 256))
            assert list(encoder(NAME).encode(text)) == tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_equals_a_plain_search(lengths):
    lengths = sorted(lengths, reverse=True)
    free: list[int] = []
    for n in lengths:
        fits = [c for c in free if c >= n]
        if fits:
            i = free.index(min(fits))
            free[i] -= n
        else:
            free.append(64 - n)
    number, offset = best_fit_decreasing(np.array(lengths, np.int64), 64)
    used = {}
    for n, w, o in zip(lengths, number.tolist(), offset.tolist()):
        assert used.get(w, 0) == o
        used[w] = o + n
    assert sorted(64 - u for u in used.values()) == sorted(free)


def test_tightest_window():
    t = OpenWindows(10)
    assert t.tightest(1) == -1
    t.place(4), t.place(7)
    assert (t.tightest(3), t.tightest(4), t.tightest(7)) == (3, 6, -1)


@pytest.mark.parametrize("window", [8, 1024])
def test_every_id_lies_in_one_piece(spark, window):
    long = "Abc déf, 123\n" * 900
    rows = [(1, long, "x"), (2, None, "x"), (3, "", "x"), (4, "one", "x"), (4, "one", "x"), (None, "no id", "x"), (5, "x" * 9000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    got = pack(docs, window=window, bucket_bytes=6000).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path(NAME))
    for id, text, copies in ((1, long, 1), (2, "", 1), (3, "", 1), (4, "one", 2), (5, "x" * 9000, 1)):
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [0], "<u4")
        own = got[got.doc_id == id].sort_values("start")
        assert own.length.sum() == copies * len(ids) and set(own.doc_tokens) == {len(ids)}
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert got.doc_id.isna().sum() >= 1
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert list(seq.offset) == [0, *seq.length.cumsum()[:-1]] and seq.length.sum() <= window
        used = seq.length.sum()
        assert set(seq.padded_length) == {used if used & (used - 1) == 0 else window}


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_large_ids_beside_a_null_stay_exact(spark):
    rows = [(2**53 + 1, "one two"), (2**53 + 3, "three"), (None, "no id")]
    got = pack(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 2**53 + 1, 2**53 + 3]
