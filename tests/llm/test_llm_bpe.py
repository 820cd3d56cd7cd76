"""BPE as an automaton: ids and texts equal the library's; the compiled states hold what a plain construction gives."""

import json
import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketflow.llm import bpe
from marketflow.llm.bpe import ASCII_WORDS, BMP_WORDS, WORDS, Automaton, Codec, codec, decode, encode

NAME = "byte_bpe_50k.json"
TOK = Tokenizer.from_file(public_tokenizers.path(NAME))


def ids_of(text):
    return TOK.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_ids_and_texts_equal_the_library(text):
    ids = list(codec(NAME).encode(text))
    assert ids == ids_of(text)
    assert codec(NAME).decode(ids) == TOK.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftext", "a" * 3000, "ab" * 2000, " \n\t" * 500, "x" * 20_000 + "é" * 999, "zzz'll 'LL 12345"])
def test_special_strings_and_long_words(text):
    assert list(codec(NAME).encode(text)) == ids_of(text)


def test_every_code_point():
    for low in range(0, 0x110000, 256):
        if not 0xD800 <= low < 0xE000:
            text = "\n".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}" for c in range(low, low + 256))
            assert list(codec(NAME).encode(text)) == ids_of(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50_300), max_size=30))
def test_any_ids_decode_as_the_library_does(ids):
    assert codec(NAME).decode(ids) == TOK.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(max_codepoint=127), max_size=40))
def test_words_of_ascii_texts_are_the_same(text):
    assert ASCII_WORDS.findall(text) == WORDS.findall(text)


def test_words_of_all_ascii_neighbours_are_the_same():
    text = "".join(chr(a) + chr(b) + chr(c) for a in range(128) for b in range(128) for c in (32, 39, 97))
    assert ASCII_WORDS.findall(text) == WORDS.findall(text)


def test_words_of_all_16_bit_characters_are_the_same():
    for low in range(0, 0x10000, 256):
        if not 0xD800 <= low < 0xE000:
            text = "".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}'s{chr(c)} \n{chr(c)}" for c in range(low, low + 256))
            assert BMP_WORDS.findall(text) == WORDS.findall(text)


def made_up(n, seed):
    """Different words of pieces that no vocabulary has as a whole; most lead the walk into places without a way on."""
    rng = random.Random(seed)
    pieces = ["th", "the", "tion", "er", "he", "ou", "éa", "zu", "sch", "å", "中", "q", "ing", "ng", "777", "\u2003"]
    return list(dict.fromkeys(" " + "".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(n)))


def test_new_words_are_walked_together(monkeypatch):
    alone, path = [], Automaton.path
    monkeypatch.setattr(Automaton, "path", lambda self, word: alone.append(word) or path(self, word))
    fresh, text = Codec(public_tokenizers.path(NAME)), "".join(made_up(6000, 1))
    assert list(fresh.encode(text)) == ids_of(text)
    assert len(alone) < 100


def test_decoding_builds_no_states(monkeypatch):
    monkeypatch.setattr(bpe, "Automaton", None)
    assert Codec(public_tokenizers.path(NAME)).decode([39, 72]) == TOK.decode([39, 72])


def test_paths_of_many_words_are_those_of_each():
    rng = random.Random(2)
    words = [w.encode() for w in made_up(3000, 3)] + [rng.randbytes(rng.randint(1, 12)) for _ in range(2000)] + [b"", b"a" * 500, b"\xff" * 90]
    automaton = codec(NAME).automaton
    rng.shuffle(words)
    assert automaton.paths(words).to_pylist() == [automaton.path(w) for w in words]
    assert automaton.paths([]).to_pylist() == [] and automaton.paths([b"hi"]).to_pylist() == [automaton.path(b"hi")]


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    fresh = Codec(public_tokenizers.path(NAME))
    texts = ["".join(made_up(30, n % 5)) + "<|endoftext|>" for n in range(20)]
    assert [list(fresh.encode(t)) for t in texts] == [ids_of(t) for t in texts]
    assert len(fresh.known) < 100
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 0)
    assert [fresh.ids(pa.array(texts[n : n + 7])).to_pylist() for n in (0, 7, 14)] == [[ids_of(t) for t in texts[n : n + 7]] for n in (0, 7, 14)]


def test_new_words_of_one_long_text_are_walked_in_blocks(monkeypatch):
    sizes, paths = [], Automaton.paths
    monkeypatch.setattr(Automaton, "paths", lambda self, words: sizes.append(sum(map(len, words))) or paths(self, words))
    monkeypatch.setattr(bpe, "SIZE", 1000)
    fresh, text = Codec(public_tokenizers.path(NAME)), "".join(made_up(2000, 6)) + " " + "x" * 5000 + "".join(made_up(2000, 7))
    assert list(fresh.encode(text)) == ids_of(text)
    assert len(sizes) > 20 and sorted(sizes)[-2] < 1100


def test_texts_that_are_no_utf8_leave_their_neighbours_alone():
    rows = [[39], [], None, [50_000, None, 39], ids_of("é中")[:1], ids_of("é中"), [10**6, -1], ids_of("x😀y")[:2], ids_of("x😀y")]
    got = codec(NAME).texts(pa.array(rows, pa.list_(pa.int32()))).to_pylist()
    assert got == [TOK.decode([i for i in ids or [] if i is not None and 0 <= i < 50_257], skip_special_tokens=False) for ids in rows]


def test_rows_of_all_sizes_stay_in_their_rows(spark):
    rng = random.Random(4)
    texts = ["", None, *("".join(made_up(rng.choice([0, 1, 3, 200]), n)) for n in range(700)), "".join(made_up(90_000, 5))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    made = encode(df, NAME)
    assert {r.doc_id: r.ids for r in made.collect()} == {i: ids_of(t or "") for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in decode(made, NAME).collect()} == {i: t or "" for i, t in enumerate(texts)}


def plain_automaton(bytes_of, pairs):
    """Arcs as sets: each merge copies a state whole and edits the copy."""
    arcs = [{t: 0 for t in bytes_of}]
    target = dict.fromkeys(bytes_of, 0)
    for u, v, made in pairs:
        old, past = target[u], target[v]
        came = [q for q in range(len(arcs)) if u in arcs[q]]
        arcs.append({t: None for t in arcs[old] if t != v})
        target[u], target[made] = len(arcs) - 1, past
        applies = v in arcs[old]
        came += [len(arcs) - 1] if u in arcs[-1] else []
        for q in came:
            if applies:
                arcs[q][made] = None
    return arcs, target


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), max_size=14), st.integers(2, 4))
def test_states_equal_a_plain_construction(picks, letters):
    base = list(range(letters))
    label, pairs = {i: bytes([i]) for i in base}, []
    for a, b in picks:
        u, v = list(label)[a % len(label)], list(label)[b % len(label)]
        # as in training, a merge joins tokens that do stand side by side, and makes a new string
        arcs, target = plain_automaton(base, pairs)
        if label[u] + label[v] in label.values() or v not in arcs[target[u]]:
            continue
        pairs.append((u, v, len(label)))
        label[len(label)] = label[u] + label[v]
    arcs, target = plain_automaton(base, pairs)
    automaton = Automaton(list(range(256)), [(u if u < letters else u - letters + 256, v if v < letters else v - letters + 256, m - letters + 256) for u, v, m in pairs])
    name = lambda t: t if t < letters else t - letters + 256
    for x in label:
        for y in label:
            assert (automaton.step(automaton.target[name(x)], name(y)) >= 0) == (y in arcs[target[x]])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), max_size=14), st.lists(st.binary(max_size=9), min_size=20, max_size=60))
def test_small_automata_walk_many_words_as_each(picks, words):
    known, pairs = list(range(256)), []
    label = {i: bytes([i]) for i in known}
    for a, b in picks:
        u, v = known[a % len(known)] % 300, known[b % len(known)] % 300
        u, v = (u if u in label else 97), (v if v in label else 98)
        if label[u] + label[v] not in label.values() and Automaton(list(range(256)), pairs).step(Automaton(list(range(256)), pairs).target[u], v) >= 0:
            pairs.append((u, v, len(known)))
            label[len(known)] = label[u] + label[v]
            known.append(len(known))
    words = words + [label[u] + label[v] for u in list(label)[-6:] for v in list(label)[-6:]]
    automaton = Automaton(list(range(256)), pairs)
    assert automaton.paths(words).to_pylist() == [automaton.path(w) for w in words]


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        Automaton(list(range(256)), [(300, 1, 301)])


def test_another_kind_of_file_is_refused(tmp_path):
    told = json.load(open(public_tokenizers.path(NAME), encoding="utf-8"))
    told["normalizer"] = {"type": "NFC"}
    (tmp_path / "t.json").write_text(json.dumps(told))
    with pytest.raises(ValueError):
        codec(str(tmp_path / "t.json"))


def test_columns_rows_and_nulls_stay(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abc de,\n中é") for _ in range(200_000))
    rows = [(1, None, "x", 5), (2, "", "y", None), (2, "", "y", None), (None, "Hi there", None, 1), (3, long, "z", 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, it int")
    made = encode(df, NAME, to="token ids")
    back = decode(made, NAME, ids="token ids")
    assert back.columns == ["doc_id", "ids", "it", "text"]
    got = sorted(back.collect(), key=repr)
    assert [(r.doc_id, r.text or "", r.ids, r.it) for r in got] == [(i, t or "", s, n) for i, t, s, n in sorted(((i, t or "", s, n) for i, t, s, n in rows), key=lambda r: repr(next(g for g in got if (g.doc_id, g.ids, g.it) == (r[0], r[2], r[3]))))]
    ids = {r.doc_id: r["token ids"] for r in made.collect()}
    assert ids[1] == ids[2] == [] and ids[None] == ids_of("Hi there") and ids[3] == ids_of(long)
    assert encode(df.limit(0), NAME).collect() == []
    odd = spark.createDataFrame([(None,), ([None, 10**6, 39],)], "ids array<int>")
    assert sorted(r.text for r in decode(odd, NAME).collect()) == ["", "H"]
