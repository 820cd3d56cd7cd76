"""Sequence packing by best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import parts, text_bytes

PLACES = ["sequence_id", "offset", "sequence_tokens", "padded_length"]
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class Encoder:
    """Token ids of a text by a byte-level BPE file of ``tokenizers``.

    Where the file's merges come in the order of their ids, the file is also a
    table of ranks, which ``tiktoken`` turns into the same ids several times as
    fast (the tests hold both against each other over all code points). Other
    files, and texts that hold one of the file's special strings, go to
    ``tokenizers``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.ranks = self._ranks(told)

    def _ranks(self, told: dict):
        import tiktoken
        from public_tokenizers import PATTERN

        model, pre = told["model"], told.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not told.get("normalizer") and model.get("type") == "BPE"
        if not plain or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        vocabulary = model["vocab"]
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if any(vocabulary[m] != 256 + i for i, m in enumerate(merges)):
            return None
        # byte-level files write a byte as itself if it prints, others as the characters from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in word): i for word, i in vocabulary.items() if word not in self.special}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.ranks is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.ranks.encode_ordinary(text), "<u4")


@lru_cache(maxsize=2)
def encoder(tokenizer: str) -> Encoder:
    """One encoder per worker. ``tokenizer``: a file, or the name of a public one."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if not os.path.isabs(tokenizer):
        import public_tokenizers

        tokenizer = public_tokenizers.path(tokenizer)
    return Encoder(tokenizer)


def pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents as pieces: full windows first, then what remains of each.

    A document is its ids and ``end_id``; a null text counts as empty, so every
    row gives at least one piece.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = []
                keys = part.column(0).to_pylist()
                for key, t in zip(keys, part.column(1)):
                    ids = np.append(encode(t.as_py() or ""), np.uint32(end_id)).astype("<u4")
                    n = len(ids)
                    rows += [(key, s, min(window, n - s), zlib.crc32(ids[s : s + window].tobytes()), n) for s in range(0, n, window)]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, PIECES)


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree.

    A leaf stands for one capacity and tells how many open windows have it; an
    inner node holds the sum. The tightest window that takes a piece is the first
    leaf at or right of the piece's length that isn't empty.
    """

    def __init__(self, window: int):
        self.window = window
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]
        self.opened = 0

    def _add(self, capacity: int, change: int) -> None:
        i = self.size + capacity
        while i:
            self.tree[i] += change
            i >>= 1

    def tightest(self, length: int) -> int:
        """The smallest capacity >= length of an open window, or -1."""
        tree, i = self.tree, self.size + length
        while not tree[i]:
            while i & 1:  # a right child: nothing further right below its parent
                i >>= 1
                if not i:
                    return -1
            i += 1
        while i < self.size:
            i *= 2
            if not tree[i]:
                i += 1
        return i - self.size

    def place(self, length: int) -> tuple[int, int]:
        """Window and offset for a piece."""
        capacity = self.tightest(length)
        if capacity < 0:
            number, capacity = self.opened, self.window
            self.opened += 1
        else:
            number = self.at[capacity].pop()
            self._add(capacity, -1)
        left = capacity - length
        if left:
            self.at[left].append(number)
            self._add(left, 1)
        return number, self.window - capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; ``lengths`` in descending order."""
    full = int((lengths >= window).sum())
    number, offset = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
    tree = OpenWindows(window)
    for i, length in enumerate(lengths[full:].tolist(), full):
        n, offset[i] = tree.place(length)
        number[i] = full + n
    return number, offset


def pack(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    window: int = 1024,
    end_id: int = 0,
    bucket_bytes: int = 16 << 20,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pack documents into sequences of at most ``window`` tokens.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, sequence_tokens and padded_length (the next power of two for a
    sequence that is one, otherwise ``window``).

    Only the pieces' lengths are shuffled, never ids or texts. They are dealt by
    hash to buckets of about ``bucket_bytes`` of text, each packed by itself: a
    bucket's memory is bounded at any input size, and it loses a few windows to
    padding at most. Full windows take no search.

    Null text: an empty document of one id. Empty table: no rows. Null doc_id and
    repeated rows: packed like any other row. Ties of length go by doc_id and
    start. Other columns aren't looked at.
    """
    total, rows = text_bytes(docs, text)
    buckets = parts(total + rows, bucket_bytes)

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        table = table.take(order).drop_columns(["bucket"])
        lengths = table["length"].to_numpy()
        number, offset = best_fit_decreasing(lengths, window)
        used = np.bincount(number, weights=lengths).astype(np.int64)[number]
        made = [(key[0].as_py() << 40) + number, offset, used, np.where(used & (used - 1), window, used)]
        for name, values in zip(PLACES, made):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    cut = pieces(docs, tokenizer, window, end_id, id, text)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(fill, PIECES + "".join(f", {name} bigint" for name in PLACES))
