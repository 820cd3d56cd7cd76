"""How filters interact: what each removes in every order, from counts by the mask of failed filters.

Which filters a document fails doesn't depend on the order, so documents are
counted once by part and mask, and all orders are sums over 32 counts.

Whether a text repeats an earlier document's takes comparing whole texts. A
counting Bloom filter goes first: each task counts the slots of its texts'
hashes, the sketches are added up, and a text with a slot that nothing else uses
is unique for certain. Only texts without such a slot are shuffled.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import stored

#: ASCII white space ends a word.
SPACE = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
#: Slots for each document, slots that a text counts in, and slots of one segment (a text's lie in the same one).
SLOTS, HASHES, SEGMENT = 8, 3, 4096


def with_failures(df: DataFrame) -> DataFrame:
    """``df`` (a column text) with ``own``: mask of the filters A to D that a text fails by itself."""
    df = df.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    fails = [
        F.size("words") < 100,
        100 * F.size(F.array_distinct("words")) < 80 * F.size("words"),
        100 * capitals.cast("bigint") > 10 * F.length("text").cast("bigint"),
        F.col("text").rlike("[#$%&*|]"),
    ]
    return df.withColumn("own", sum(F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails))).drop("words")


def _with_slots(df: DataFrame, segments: int) -> DataFrame:
    """``df`` (a column h) with the segment of the hash and its slots s0, s1, .. there."""
    bits = SEGMENT.bit_length() - 1
    df = df.withColumn("segment", F.pmod(F.xxhash64("h"), F.lit(segments)))
    return df.withColumns({f"s{i}": F.shiftrightunsigned("h", bits * i).bitwiseAND(SEGMENT - 1).cast("int") for i in range(HASHES)})


def sketch(hashes: DataFrame, rows: int, most_segments: int) -> tuple[DataFrame, int]:
    """Segments of the counting Bloom filter as bits of the slots counted twice or more, and how many segments there are.

    ``hashes``: a column h. A counter is one row (segment, slot, n), and only those
    in use have one; each task adds up its own before they are merged. A segment
    without a slot counted twice has no row.
    """
    segments = max(1, min(most_segments, -(-rows * SLOTS // SEGMENT)))
    used = _with_slots(hashes.select("h"), segments).select("segment", F.explode(F.array_distinct(F.array(*(f"s{i}" for i in range(HASHES))))).alias("slot"))
    twice = used.groupBy("segment", "slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    words = twice.groupBy("segment", F.expr("slot div 64").cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, slot & 63))").alias("bits"))
    merged = words.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))  # SEGMENT / 64 words at most
    every = F.transform(F.sequence(F.lit(0), F.lit(SEGMENT // 64 - 1)), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("bigint")))
    return merged.select("segment", every.alias("twice")), segments


def may_repeat(df: DataFrame, twice: DataFrame, segments: int) -> DataFrame:
    """``df`` (a column h) with a boolean ``suspect``: false if the sketch clears the text as unique.

    ``twice`` is broadcast: SEGMENT bits for each of a bounded number of segments.
    """
    own = [f"s{i}" for i in range(HASHES)]
    joined = _with_slots(df, segments).join(F.broadcast(twice), "segment", "left")
    full = F.expr(" AND ".join(f"(shiftrightunsigned(twice[{s} div 64], {s} & 63) & 1) = 1" for s in own))
    return joined.withColumn("suspect", F.coalesce(full, F.lit(False))).drop("segment", "twice", *own)


def masks(docs: DataFrame, most_segments: int = 1 << 17, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row for each (doc_id, part, mask) with the number of documents: which filters a document fails, as bits, A the least.

    Bit E: some smaller id has the same text. Rows of one id don't make each other
    repeats; a null id is smaller than none and has no smaller one.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = docs.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), whole.alias("text"))
    h = F.xxhash64("text")
    narrow = stored(with_failures(named).select("doc_id", "part", h.alias("h"), F.xxhash64(F.lit(7), "text").alias("h2"), "own"), "flags")
    rows = narrow.count()
    twice, segments = sketch(narrow, rows, most_segments)
    twice = stored(twice, "sketch")
    # exact: least id of each whole text, among those that the sketch can't clear
    suspects = may_repeat(named.filter("doc_id IS NOT NULL").select("doc_id", "text", h.alias("h")), twice, segments).filter("suspect")
    least = suspects.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    # of a repeated text, the rows of the least id; two 64-bit hashes tell apart the texts that one id may have
    first = least.select("doc_id", h.alias("h"), F.xxhash64(F.lit(7), "text").alias("h2"), F.lit(True).alias("first")).distinct()
    flags = may_repeat(narrow, twice, segments).groupBy("doc_id", "part", "h", "h2", "own", "suspect").agg(F.count(F.lit(1)).alias("n"))
    clear = ~F.col("suspect") | F.col("doc_id").isNull()
    told = flags.filter(clear).select("doc_id", "part", F.col("own").alias("mask"), "n")
    joined = flags.filter(~clear).join(first, ["doc_id", "h", "h2"], "left")
    held = joined.select("doc_id", "part", (F.col("own") + F.when(F.col("first"), 0).otherwise(REPEATED)).alias("mask"), "n")
    return told.unionByName(held)


def counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those that some label row calls good or toxic."""
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("g"), F.max((F.col("toxic") == 1).cast("int")).alias("t"))
    rows = flagged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).join(marks.filter("doc_id IS NOT NULL"), "doc_id", "left")
    of = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("g").alias("good"), of("t").alias("toxic"))


def orders(by_mask: DataFrame) -> DataFrame:
    """Every order and step of every part, from its counts by mask, zeros included.

    A filter's Shapley sum needs no orders: among the filters that a document
    fails, each comes first in an equal share of the 120.
    """
    cells = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    every = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    rows = cells.withColumn("filter_order", F.explode(every)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    rows = rows.withColumn("bit", F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, step, 1)) - 1)"))
    rows = rows.withColumn("before", sum(F.when(F.instr("filter_order", x) < F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)))
    bit, before = F.col("bit"), F.col("before")
    hits = lambda c, bits: c["mask"].bitwiseAND(bits) != 0

    def total(which, value="n"):
        worth = (lambda c: c[value]) if isinstance(value, str) else value
        return F.aggregate(F.filter("cells", which), F.lit(0).cast("bigint"), lambda a, c: a + worth(c))

    first = lambda c: hits(c, bit) & ~hits(c, before)
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: ~hits(c, bit.bitwiseOR(before))).alias("kept"),
        total(first).alias("removed"),
        total(lambda c: hits(c, bit) & hits(c, before)).alias("redundant"),
        total(lambda c: c["mask"] == bit).alias("unique_fails"),
        total(first, "good").alias("good_lost"),
        total(first, "toxic").alias("toxic_lost"),
        total(lambda c: hits(c, bit), lambda c: c["n"] * (F.lit(120) / F.bit_count(c["mask"])).cast("bigint")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (lang; null as empty), order of the filters A to E and step.

    A: under 100 words; B: under 80 % distinct words; C: over 10 % capitals A-Z; D:
    one of #$%&*|; E: the text of a smaller doc_id, removed or not. Null texts are
    empty ones. Rows of one id with one text are no repeats of each other and count
    each; a row without an id is nobody's repeat and has no label. Several labels
    of one id: good or toxic if one says so. An empty table gives no rows; other
    columns are not read, and texts of any length are taken whole.
    """
    return orders(counts(masks(docs), labels))


_FAILS = """
  CASE WHEN len(words) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END"""

#: The same from windows over whole texts and one pass per order.
SQL = f"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
perms AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x) JOIN letters d ON d.x NOT IN (a.x, b.x, c.x)
  JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM perms, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
failing AS (
  SELECT doc_id, part, {_FAILS} + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM texts),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
by_mask AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
told AS (
  SELECT part, filter_order, step, bit,
    CAST(sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM by_mask, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM told
"""
