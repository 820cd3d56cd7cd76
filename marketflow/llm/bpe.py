"""Byte-level BPE as an automaton over tokens: compiled from the merges, then read as a table.

Every valid token sequence of any text is a path from the start state, and every
text has exactly one. The automaton begins with one state and an arc for each
byte. Each merge (u, v) in turn puts its gadget in: arcs labelled u lead to a new
state, which is the old one without the arc v, and an arc uv goes past both to
where v led. So the state depends on the last token alone, each merge adds one
state, and what a state lacks against the one it was split from is one token and
whatever was later built upon that token: an interval, once tokens are numbered
along the tree of their left parts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: How byte-level files cut a text into words (fixed value of the format).
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same words in a text of ASCII characters alone, which the plain engine cuts in half the time.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


def _plain(below: int) -> re.Pattern:
    """``WORDS`` for the plain engine, right for texts whose code points are all less than ``below``."""
    of = lambda kind: "".join(f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in regex.findall(kind + "+", "".join(map(chr, range(below)))))
    space, letter, digit = of(r"\s"), of(r"\p{L}"), of(r"\p{N}")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+")


#: The same words in a text without code points beyond 16 bits, likewise.
BMP_WORDS = _plain(0x10000)
#: Words up to this many bytes are walked together while more than so many are left, others each alone.
SHORT, FEW = 96, 16
#: Words, and bytes of them, after which a worker forgets those it knows.
REMEMBERED, REMEMBERED_BYTES = 1 << 18, 1 << 23
#: Rows, and bytes of text or ids, that a task takes at once (one row at least).
ROWS, SIZE = 512, 1 << 20


def words_of(text: str) -> list[str]:
    """The words of a text, cut by the fastest pattern that is right for it."""
    if text.isascii():
        return ASCII_WORDS.findall(text)
    return (BMP_WORDS if len(text.encode("utf-16-le")) == 2 * len(text) else WORDS).findall(text)


def labels_of(bytes_of: list[int], pairs: list[tuple[int, int, int]]) -> dict[int, bytes]:
    """What each token spells, by the merges ``pairs`` over the tokens of single bytes."""
    label = {token: bytes([b]) for b, token in enumerate(bytes_of)}
    for u, v, made in pairs:
        if u not in label or v not in label or made in label:
            raise ValueError("each merge must join tokens made before it into a new one")
        label[made] = label[u] + label[v]
    return label


def byte_of() -> dict[str, int]:
    """The character that stands for each byte: itself if it prints, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """States and arcs for the merges ``pairs`` (left id, right id, made id), best first, over 256 byte tokens.

    ``bytes_of``: the id of each single byte. A state is kept as the state that it
    was split from and the interval of tokens it lost; ``lacks`` lists all that a
    state has lost, once it is asked for.
    """

    def __init__(self, bytes_of: list[int], pairs: list[tuple[int, int, int]]):
        self.label = labels_of(bytes_of, pairs)
        built: dict[int, list[tuple[int, int]]] = {token: [] for token in bytes_of}  # (rank, made) upon a left part
        for rank, (u, v, made) in enumerate(pairs):
            built[u].append((rank, made))
            built[made] = []
        self.place, end = self._numbered(bytes_of, built)
        self.split_from, self.low, self.high = array("i", [-1]), array("i", [0]), array("i", [0])
        self.target = dict.fromkeys(bytes_of, 0)
        for rank, (u, v, made) in enumerate(pairs):
            i = bisect_left(built[v], (rank, -1))
            self.split_from.append(self.target[u])
            self.low.append(self.place[v])
            # what was built upon v before this merge stands behind what came later, and stays
            self.high.append(self.place[built[v][i - 1][1]] if i else end[v])
            self.target[made] = self.target[v]
            self.target[u] = len(self.low) - 1
        self.lost: dict[int, tuple[list[int], list[int]]] = {}
        self._prefixes()
        self._tables()

    @staticmethod
    def _numbered(roots, built) -> tuple[dict[int, int], dict[int, int]]:
        """Each token's place in a walk over the trees of left parts, latest merge first, and the end of its subtree."""
        place: dict[int, int] = {}
        end: dict[int, int] = {}
        todo = [(token, False) for token in reversed(roots)]
        while todo:
            token, done = todo.pop()
            if done:
                end[token] = len(place)
                continue
            place[token] = len(place)
            todo.append((token, True))
            todo += [(made, False) for _, made in built[token]]
        return place, end

    def _prefixes(self) -> None:
        """A trie over the labels, its arcs in one row: that of ``node`` for byte b is at ``base[node] + b`` if ``owner`` there is ``node``.

        ``ends``: the token that ends at a node, or -1. ``shorter``: a token's longest prefix that is a token, or -1.
        """
        arcs: list[dict[int, int]] = [{}]
        ends, before, self.shorter = [-1], [-1], dict.fromkeys(self.label, -1)
        for token, label in self.label.items():
            at = 0
            for b in label:
                on = arcs[at].get(b)
                if on is None:
                    on = arcs[at][b] = len(arcs)
                    arcs.append({})
                    ends.append(-1)
                    before.append(at)
                at = on
            ends[at] = token
        near = [-1] * len(arcs)  # the last token above a node
        for node in range(1, len(arcs)):
            above = before[node]
            near[node] = ends[above] if ends[above] >= 0 else near[above]
            if ends[node] >= 0:
                self.shorter[ends[node]] = near[node]
        self.base, self.owner, self.child = [0] * len(arcs), [-1] * 512, [0] * 512
        at, free = 0, 256
        for node in sorted(range(len(arcs)), key=lambda i: -len(arcs[i])):
            own = arcs[node]
            if len(own) > 1:
                while any(self.owner[at + b] >= 0 for b in own):
                    at += 1
                place = at
            elif own:  # a single arc takes the first gap
                while self.owner[free] >= 0:
                    free += 1
                place = free - min(own)
            else:
                break
            self.base[node] = place
            for b, on in own.items():
                self.owner[place + b], self.child[place + b] = node, on
            more = place + 513 - len(self.owner)
            self.owner += [-1] * more
            self.child += [0] * more
        self.ends = ends

    def _tables(self) -> None:
        """What many words at a time are looked up in, as arrays: the trie, the tokens, and what all states lack, one after another."""
        size = max(self.label) + 2  # the last is found at -1, for no token
        of = lambda told, none=0: np.array([told.get(t, none) for t in range(size)], np.int64)
        self.trie = [np.array(x, np.int32) for x in (self.base, self.owner, self.child, self.ends)]
        self.tokens = of({t: len(x) for t, x in self.label.items()}), of(self.shorter, -1), of(self.place), of(self.target)
        lows, highs, each = array("q", [-1]), array("q", [-1]), len(self.place)
        for state in sorted(set(self.target.values())):
            low, high = self.lacks(state)
            lows.extend([state * each + x for x in low])
            highs.extend([state * each + x for x in high])
            del self.lost[state]
        self.all_lost = np.array(lows), np.array(highs)

    def lacks(self, state: int) -> tuple[list[int], list[int]]:
        """Begins and ends of the disjoint intervals of tokens that have no arc from ``state``."""
        known = self.lost.get(state)
        if known is None:
            cuts, at = [], state
            while at > 0:
                cuts.append((self.low[at], self.high[at]))
                at = self.split_from[at]
            lows, highs = [], []
            for low, high in sorted(cuts):
                if lows and low <= highs[-1]:
                    highs[-1] = max(highs[-1], high)
                else:
                    lows.append(low)
                    highs.append(high)
            known = self.lost[state] = lows, highs
        return known

    def step(self, state: int, token: int) -> int:
        """Where the arc ``token`` leads from ``state``; -1 if there is none."""
        lows, highs = self.lacks(state)
        at = bisect_right(lows, self.place[token]) - 1
        return -1 if at >= 0 and self.place[token] < highs[at] else self.target[token]

    def path(self, word: bytes) -> list[int]:
        """The labels of the only path that spells ``word``.

        From each state the longest arc that spells what follows is taken first.
        A place from which no arc leads on is never entered again, since only one
        path leads to it.
        """
        n, at, state = len(word), 0, 0
        lost, places, target, label = self.lost, self.place, self.target, self.label
        base, owner, child, ends = self.base, self.owner, self.child, self.ends
        out, dead = [], set()
        below = n + 1  # where the next arc must end before
        while at < n:
            ahead, node = [], 0
            for j in range(at, n):
                arc = base[node] + word[j]
                if owner[arc] != node:
                    break
                node = child[arc]
                if ends[node] >= 0 and j + 1 < below:
                    ahead.append(ends[node])
            lows, highs = lost.get(state) or self.lacks(state)
            while ahead:
                token = ahead.pop()
                place = places[token]
                i = bisect_right(lows, place) - 1
                if i < 0 or place >= highs[i]:
                    j = at + len(label[token])
                    if j not in dead:
                        out.append(token)
                        at, state, below = j, target[token], n + 1
                        break
            else:
                dead.add(at)
                below = at
                at -= len(label[out.pop()])
                state = target[out[-1]] if out else 0
        return out

    def _longest(self, text: np.ndarray) -> np.ndarray:
        """At each place of ``text`` (bytes, 256 behind each word) the longest token that begins there, -1 where there is none."""
        base, owner, child, ends = self.trie
        longest, at, node = np.full(len(text), -1, np.int64), np.arange(len(text)), np.zeros(len(text), np.int32)
        ahead = 0
        while len(at):
            arc = base[node] + text[at + ahead]
            on = owner[arc] == node
            at, node = at[on], child[arc[on]]
            token = ends[node]
            told = token >= 0
            longest[at[told]] = token[told]
            ahead += 1
        return longest

    def paths(self, words: list[bytes]) -> pa.ListArray:
        """The labels of the path of each word, found as in ``path`` for all words at once.

        In a round each word tries one arc: it goes on by it, turns to the next
        shorter one, or from a place that has no other goes back. The last few
        words, and long ones, are left to ``path``.
        """
        length, shorter, place, target = self.tokens
        lows, highs = self.all_lost
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero((lengths > 0) & (lengths <= SHORT))
        text = np.frombuffer(b"".join([words[i] + b"\0" for i in short]), np.uint8).astype(np.int32)
        ends = np.cumsum(lengths[short] + 1) - 1
        text[ends] = 256
        longest = self._longest(text)
        came, dead = np.full(len(text), -1), np.zeros(len(text), bool)  # the arc that led to a place
        which, end, at = short, ends, ends - lengths[short]
        token = longest[at]
        while len(which) > FEW:
            stuck = np.flatnonzero(token < 0)
            if len(stuck):
                dead[at[stuck]] = True
                back = came[at[stuck]]
                if (back < 0).any():
                    raise ValueError("these merges give a text no path")
                at[stuck] -= length[back]
                token[stuck] = shorter[back]
            key, to = target[came[at]] * len(self.place) + place[token], at + length[token]
            on = (token >= 0) & ~dead[to] & (key >= highs[np.searchsorted(lows, key, "right") - 1])
            came[to[on]] = token[on]
            at, token = np.where(on, to, at), np.where(on, longest[to], shorter[token])
            left = at < end
            which, end, at, token = which[left], end[left], at[left], token[left]
        walked = ~np.isin(short, which)
        alone = {i: self.path(words[i]) for i in [*which, *np.flatnonzero(lengths > SHORT)]}
        whose, said = [np.repeat(np.array([*alone], np.int64), np.array([len(x) for x in alone.values()], np.int64))], [np.array([t for x in alone.values() for t in reversed(x)], np.int64)]
        which, at = short[walked], ends[walked]
        while len(which):
            whose.append(which)
            said.append(came[at])
            at = at - length[said[-1]]
            left = came[at] >= 0
            which, at = which[left], at[left]
        order = np.argsort(np.concatenate(whose)[::-1], kind="stable")
        return _lists(np.concatenate(said)[::-1][order], np.bincount(np.concatenate(whose), minlength=len(words)))


class Numbers(dict):
    """Words and their numbers; a word not met before gets the next one and a place in ``new``."""

    def __init__(self, first):
        super().__init__(first)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class Codec:
    """Encoder and decoder of one byte-level BPE file, as the ``tokenizers`` library reads it.

    Strings of added tokens in a text become those tokens. Other kinds of files
    (another model, normalizers, other pre-tokenizers) are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, pre = told["model"], told.get("pre_tokenizer") or {}
        byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        added = told.get("added_tokens") or []
        if model.get("type") != "BPE" or not byte_level or told.get("normalizer") or odd or any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        ids, byte = model["vocab"], byte_of()
        of = {b: ids[c] for c, b in byte.items()}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = [of[b] for b in range(256)], [(ids[u], ids[v], ids[u + v]) for u, v in merges]
        self.special = {t["content"]: t["id"] for t in added}
        # what no merge makes is never encoded, yet may be decoded
        written = {i: bytes(byte[c] for c in word) if set(word) <= byte.keys() else word.encode() for word, i in (ids | self.special).items()}
        written |= labels_of(*self.merges)
        # the last one stands for ids that are none
        self.label = pa.array([written.get(i, b"") for i in range(max(written) + 2)], pa.binary())
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self._forget()

    @cached_property
    def automaton(self) -> Automaton:
        return Automaton(*self.merges)

    def _forget(self) -> None:
        # what is cut out of a text is never a word of the rest
        self.known, self.known_bytes = Numbers(zip(self.special, range(len(self.special)))), 0
        self.spelt = pa.array([[i] for i in self.special.values()], pa.list_(pa.int32()))  # ids, by the words' numbers

    def _learn(self) -> None:
        """Walks the words that were met for the first time, some ``SIZE`` bytes of them together."""
        words = [w.encode("utf-8") for w in self.known.new]
        ends = np.cumsum([len(w) for w in words])
        cuts = [0, *np.flatnonzero(np.diff(ends // SIZE)) + 1, len(words)]
        self.spelt = pa.concat_arrays([self.spelt, *(self.automaton.paths(words[i:j]) for i, j in pairwise(cuts))])
        self.known_bytes += int(ends[-1])
        self.known.new.clear()

    def ids(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text. Words of late are remembered, so that each is walked once."""
        if len(self.known) > REMEMBERED or self.known_bytes > REMEMBERED_BYTES:
            self._forget()
        number, numbers, ends = self.known.__getitem__, [np.zeros(0, np.int32)], [0]
        for text in texts.to_pylist():
            size = 0
            for i, part in enumerate(self.cut.split(text or "") if self.cut else [text or ""]):
                words = [part] if i % 2 else words_of(part)
                numbers.append(np.fromiter(map(number, words), np.int32, len(words)))
                size += len(words)
            ends.append(ends[-1] + size)
        if self.known.new:
            self._learn()
        found = self.spelt.take(pa.array(np.concatenate(numbers)))
        return pa.ListArray.from_arrays(found.offsets.take(pa.array(ends)), found.values)

    def texts(self, ids: pa.Array) -> pa.Array:
        """The labels of the arcs of each row one after another; what isn't UTF-8 becomes U+FFFD, unknown ids nothing."""
        none = len(self.label) - 1
        flat = ids.flatten().fill_null(none).to_numpy()
        found = self.label.take(pa.array(np.where((flat < 0) | (flat > none), none, flat)))
        begins = np.frombuffer(found.buffers()[1], np.int32, len(flat) + 1)
        ends = np.cumsum(np.concatenate([[0], ids.value_lengths().fill_null(0).to_numpy()]))
        offsets = pa.py_buffer(begins[ends])
        made = pa.StringArray.from_buffers(len(ids), offsets, found.buffers()[2])
        try:
            made.validate(full=True)
        except pa.ArrowInvalid:
            plain = pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, offsets, found.buffers()[2]])
            made = pa.array([x.decode("utf-8", "replace") for x in plain.to_pylist()], pa.string())
        return made

    def encode(self, text: str) -> array:
        return array("i", self.ids(pa.array([text], pa.string())).values.to_pylist())

    def decode(self, ids: list[int]) -> str:
        return self.texts(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


@lru_cache(maxsize=2)
def codec(tokenizer: str) -> Codec:
    """One per worker. ``tokenizer``: a file that executors see, or the name of a public one."""
    if not os.path.isabs(tokenizer):
        import public_tokenizers

        tokenizer = public_tokenizers.path(tokenizer)
    return Codec(tokenizer)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _mapped(df: DataFrame, column: str, to: StructField, converter) -> DataFrame:
    """``df`` with ``column`` replaced by what is made of it, in batches of bounded rows and size.

    ``converter()`` gives, in a task, a function of an Arrow column that makes
    the new one, and one that tells the size of each of its values.
    """
    others = [c for c in df.columns if c != column]
    names = [f"c{i}" for i in range(len(others))]
    source = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(others, names)), F.col(f"`{column}`").alias("it"))
    out = StructType([*source.schema.fields[:-1], StructField("it", to.dataType)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made_of, size_of = converter()
        for batch in batches:
            sizes = np.cumsum(size_of(batch.columns[-1]).fill_null(0).to_numpy())
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                end = min(at + ROWS, max(at + 1, int(np.searchsorted(sizes, before + SIZE, "right"))))
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made_of(part.columns[-1])], names=batch.schema.names)
                at = min(end, batch.num_rows)

    mapped = source.mapInArrow(work, out)
    return mapped.select(*(F.col(n).alias(c) for n, c in zip(names, others)), F.col("it").alias(to.name))


def encode(df: DataFrame, tokenizer: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with the column ``text`` replaced by its token ids, an array of int named ``to``.

    A null or empty text has no ids. Rows are never moved:
    nulls, repeats and order of other columns, whatever their names, stay as they
    are, and an empty table stays empty. A text's words are held at once, so the
    memory of a task grows with the longest text alone.
    """

    def converter():
        return codec(tokenizer).ids, pc.binary_length

    return _mapped(df, text, StructField(to, ArrayType(IntegerType())), converter)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", to: str = "text") -> DataFrame:
    """``df`` with the column ``ids`` replaced by the text that they spell, special tokens included.

    Null ids give an empty text; null or unknown ids within an array say nothing.
    """

    def converter():
        return codec(tokenizer).texts, lambda ids: pc.multiply(pc.list_value_length(ids), 4)

    return _mapped(df, ids, StructField(to, StringType()), converter)
