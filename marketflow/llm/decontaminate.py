"""Benchmark decontamination: runs of equal tokens that no overlap can do without find candidate alignments, token comparison confirms them."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import parts, text_bytes

#: Items of fewer tokens aren't sought.
LEAST_TOKENS = 3
#: Seed hits that are compared at once.
HITS = 1 << 16
#: Characters of an item in one piece, and of a piece that its successor repeats.
PIECE, LAP = 20_000, 2_000
#: Characters that are split into words at once.
CHUNK = 1 << 20
FILTER_BITS = 22

WORD = re.compile(r"\w+")
SCHEMA = "array<struct<item_id:bigint,doc_start:int,length:int,matched:int>>"
OVERLAPS = pa.list_(pa.struct([("item_id", pa.int64()), ("doc_start", pa.int32()), ("length", pa.int32()), ("matched", pa.int32())]))


def words(text: str) -> Iterator[list[str]]:
    """The lower-cased words of a text, in bounded lists."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        while at < end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        yield WORD.findall(text[at:end].lower())
        at = end


def seed_hash(ids: np.ndarray, run: int) -> np.ndarray:
    """A hash of each ``run`` tokens in a row."""
    n = len(ids) - run + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, run, np.uint64)
    for o in range(run):
        h = (h ^ ids[o : o + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def equal_run(need: int, share: float) -> int:
    """The equal tokens in a row that ``need`` tokens hold, wherever those stand that may differ."""
    equal = math.ceil(share * need)
    return max(1, math.ceil(equal / (need - equal + 1)))


class Block:
    """The seeds of some benchmark items. Its size is bounded by the block's text."""

    def __init__(self, items: list[tuple[int, str]], least: int, share: float):
        self.least, self.share = least, share
        self.vocabulary: dict[str, int] = {}
        same: dict[tuple[int, ...], int] = {}
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for ws in words(text) for w in ws)
            if len(ids) >= LEAST_TOKENS:
                same[ids] = min(item, same.get(ids, item))  # items of equal words count once, under the least id
        self.items = list(same.values())
        self.starts = np.cumsum([0, *map(len, same)])
        self.tokens = np.array([t for ids in same for t in ids], np.uint64)
        self.item_of = np.repeat(np.arange(len(same)), np.diff(self.starts))
        self.seeds = []
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        for need in sorted({min(least, len(x)) for x in same}):
            run = equal_run(need, share)
            of = [i for i, ids in enumerate(same) if min(least, len(ids)) == need]
            at = np.concatenate([np.arange(self.starts[i], self.starts[i + 1] - run + 1) for i in of])
            h = np.concatenate([seed_hash(self.tokens[self.starts[i] : self.starts[i + 1]], run) for i in of])
            order = np.argsort(h, kind="stable")
            self.seeds.append((need, run, h[order], at[order]))
            self.filter[h >> np.uint64(64 - FILTER_BITS)] = True

    def _alike(self, ids: np.ndarray, p: np.ndarray, q: np.ndarray, need: int, run: int) -> np.ndarray:
        """Whether some ``need`` tokens around equal runs at p (text) and q (items) have enough equal ones."""
        reach = np.arange(run - need, need)
        x, y = p[:, None] + reach, q[:, None] + reach
        inside = (x >= 0) & (x < len(ids)) & (y >= 0) & (y < len(self.tokens))
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        inside &= self.item_of[y] == self.item_of[q][:, None]

        def sums(marks: np.ndarray) -> np.ndarray:
            run = np.cumsum(np.pad(marks, ((0, 0), (1, 0))), axis=1, dtype=np.int32)
            return run[:, need:] - run[:, :-need]

        return ((sums(inside) == need) & (sums(inside & (ids[x] == self.tokens[y])) >= math.ceil(self.share * need))).any(1)

    def overlaps(self, text: str) -> list[dict]:
        """Items with which the text has an aligned overlap: ``least`` tokens (or the whole item, if shorter), ``share`` of them equal."""
        get = self.vocabulary.get
        got = [np.fromiter((get(w, 0) for w in ws), np.uint64, len(ws)) for ws in words(text)]
        ids = np.concatenate(got) if got else np.zeros(0, np.uint64)
        found: dict[int, dict] = {}
        shifts: set[tuple[int, int]] = set()
        hashed: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for need, run, keys, at in self.seeds:
            if run not in hashed:
                h = seed_hash(ids, run)
                hit = np.nonzero(self.filter[h >> np.uint64(64 - FILTER_BITS)])[0]
                hashed[run] = hit, h[hit]
            hit, h = hashed[run]
            lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            place, lo, many = hit[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            ends = np.cumsum(many)
            for begin in range(0, int(ends[-1]) if len(ends) else 0, HITS):
                number = np.arange(begin, min(begin + HITS, int(ends[-1])))
                seed = np.searchsorted(ends, number, "right")
                p, q = place[seed], at[lo[seed] + number - (ends - many)[seed]]
                good = self._alike(ids, p, q, need, run)
                item = self.item_of[q[good]]
                shifts |= set(zip(item.tolist(), (p[good] - (q[good] - self.starts[item])).tolist()))
        for item, shift in shifts:
            own = self.tokens[self.starts[item] : self.starts[item + 1]]
            first, last = max(0, shift), min(len(ids), shift + len(own))
            need = min(self.least, len(own))
            if last - first < need:
                continue
            run = np.concatenate([[0], np.cumsum(ids[first:last] == own[first - shift : last - shift])])
            sums = run[need:] - run[:-need]
            best = int(sums.argmax())
            old = found.get(item)
            if sums[best] >= math.ceil(self.share * need) and (old is None or (-sums[best], first + best) < (-old["matched"], old["doc_start"])):
                found[item] = {"item_id": self.items[item], "doc_start": first + best, "length": need, "matched": int(sums[best])}
        return [found[k] for k in sorted(found)]


def blocks(benchmark: DataFrame, least: int, share: float, block_bytes: int, id: str, text: str) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes`` of text, one at a time.

    Long items are cut into overlapping pieces first, so that no block outgrows
    its size by more than a piece.
    """
    items = benchmark.select(F.col(id).cast("bigint").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("t")).filter("item_id IS NOT NULL")
    step = PIECE - LAP
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.length("t") - PIECE) / step)).cast("int"))
    pieces = items.select("item_id", F.posexplode(F.transform(starts, lambda i: F.substring(F.col("t"), i * step + 1, F.lit(PIECE)))).alias("piece", "t"))
    total, rows = text_bytes(pieces, "t")
    n = parts(total + 8 * rows, block_bytes)
    for i in range(n):
        part = pieces.filter(F.pmod(F.xxhash64("item_id", "piece"), F.lit(n)) == i)
        yield Block([(r["item_id"], r["t"]) for r in part.select("item_id", "t").distinct().collect()], least, share)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[Column],
    least: int = 13,
    share: float = 0.8,
    block_bytes: int = 4 << 20,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``keep`` and ``overlaps``: for every document the benchmark items found in its whole text.

    An overlap is an alignment without gaps of ``least`` tokens (all of an item
    that is shorter), ``share`` of which are equal; of an item's overlaps the best
    is told, the first of equals. Seeds are runs so short that every overlap has
    one equal (four tokens of 13 with two that differ), so none is missed.

    The benchmark is the stated query set: it goes to the tasks in blocks of
    bounded size, each passed over all documents, which are never shuffled.

    Null or empty text: no overlaps. Items without an id or of fewer than
    LEAST_TOKENS words are never found; items of equal words are told under their
    least id. Repeated rows come out as often as they came in. Empty tables: no
    rows, no overlaps.
    """
    spark = docs.sparkSession
    found = docs.select(*keep, F.col(text).alias("__text"), F.array().cast(SCHEMA).alias("overlaps"))
    for block in blocks(benchmark, least, share, block_bytes, item, item_text):
        if not block.seeds:
            continue
        shared = spark.sparkContext.broadcast(block)

        def seek(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                told = [a.as_py() + (own.overlaps(t.as_py()) if t.is_valid else []) for t, a in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(told, OVERLAPS)], names=batch.schema.names)

        found = found.mapInArrow(seek, found.schema)
    return found.drop("__text")


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, doc_start, length, matched): one row for each item found in a document."""
    return overlaps(docs, benchmark, [F.col("doc_id")], **options).select("doc_id", F.explode("overlaps").alias("o")).select("doc_id", "o.*")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no item was found, with all their columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return overlaps(docs, benchmark, [row], **options).filter(F.size("overlaps") == 0).select("row.*")
