"""Document fingerprints by winnowing, in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketflow.llm.common import parts, text_bytes

# Blocks of scripts written without spaces (Thai and Lao, Burmese, Khmer, kana, Han). Each
# of their letters is a token. Ranges are tested several times as fast as script names.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{323AF}"
TOKEN = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{UNSPACED}]]++|[\p{{L}}\p{{M}}\p{{N}}&&[{UNSPACED}]]"
#: Tokens in a gram, and grams in a window; both powers of two.
GRAM, WINDOW = 4, 4
LOW = (1 << 32) - 1


def _doubled(df: DataFrame, column: str, width: int, join) -> DataFrame:
    """For each place of the array ``column`` the joined ``width`` values from there on.

    Each doubling is a projection of its own, so that it is computed once.
    """
    step = 1
    while step < width:
        n = F.greatest(F.size(column) - step, F.lit(0))
        df = df.withColumn(column, F.zip_with(F.slice(column, 1, n), F.slice(column, step + 1, n), join))
        step *= 2
    return df


def with_marks(df: DataFrame, text: str, name: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds the winnowed fingerprint of ``text``: an array of longs, one for each chosen gram.

    A mark is the gram's 31-bit hash above the complement of its position, so that
    the least mark of a window is its least hash, the rightmost of equals. Grams
    and windows are built by doubling: hashes of two neighbours, then of two
    pairs. Any passage of ``gram + window - 1`` equal tokens gives two texts a hash in
    common. A text of fewer tokens than a gram has one gram, all its tokens; a
    text of fewer grams than a window has one window. No tokens: no marks.
    """
    assert gram & (gram - 1) == 0 and window & (window - 1) == 0
    t, h, c, m = (f"__{name}_{x}" for x in ("tokens", "hashes", "codes", "least"))
    df = df.withColumn(t, F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0)))
    df = df.withColumn(t, F.transform(t, lambda w: F.xxhash64(w)))
    df = _doubled(df.withColumn(h, F.col(t)), h, gram, lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(h, F.when(F.size(t) >= gram, F.col(h)).when(F.size(t) > 0, F.array(F.xxhash64(t))).otherwise(F.col(t))).drop(t)
    code = lambda x, i: F.shiftleft(x.bitwiseAND(F.lit((1 << 31) - 1).cast("bigint")), 32) + (F.lit(LOW) - i)
    df = df.withColumn(c, F.transform(h, code)).drop(h)
    df = _doubled(df.withColumn(m, F.col(c)), m, window, lambda a, b: F.least(a, b))
    least = F.when(F.size(c) >= window, F.array_distinct(m)).when(F.size(c) > 0, F.array(F.array_min(c))).otherwise(F.col(c))
    return df.withColumn(name, least).drop(c, m)


def hashes(marks: Column) -> Column:
    """The distinct hashes, in order of their positions."""
    return F.array_distinct(F.transform(marks, lambda m: F.shiftright(m, 32).cast("int")))


def positions(marks: Column) -> Column:
    """(hash, position of the gram's first token) of each mark."""
    return F.transform(marks, lambda m: F.struct(F.shiftright(m, 32).cast("int").alias("hash"), (F.lit(LOW) - m.bitwiseAND(F.lit(LOW))).cast("int").alias("position")))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds the Jaccard likeness of two sets of hashes; two empty ones are alike."""
    df = df.withColumn(name, F.size(F.array_intersect(a, b)))
    share = F.col(name) / (F.size(a) + F.size(b) - F.col(name))
    return df.withColumn(name, F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(share))


def _bucket(column: Column, bounds: list) -> Column:
    """How many bounds are at or below the value, by two short looks instead of one long one."""
    if not bounds:
        return F.lit(0)
    width = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    firsts = F.array(*(F.lit(g[0]) for g in groups))
    inner = F.array(*(F.array(*(F.lit(x) for x in g)) for g in groups))
    outer = F.size(F.filter(firsts, lambda b: b <= column))
    return F.when((outer == 0) | column.isNull(), 0).otherwise((outer - 1) * width + F.size(F.filter(F.get(inner, outer - 1), lambda b: b <= column)))


def with_next(docs: DataFrame, add, id: str = "doc_id", text: str = "text", bucket_bytes: int = 8 << 20, most: int = 4096) -> DataFrame:
    """Each document with the next one's: doc_id, text, next_text, and what ``add`` adds to both.

    Next is by ascending id (nulls first, equal ids by text hash), the first
    after the last. Ids are cut into buckets at their quantiles; a bucket also gets
    a copy of the first document of the bucket after it, so that one window in
    each bucket sees all neighbours. ``add`` (text -> columns) runs before the
    texts are shuffled, once per document.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total, rows = text_bytes(base, "text")
    n = min(most, max(parts(total + 8 * rows, bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = base.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("q")).first()["q"] if n > 1 else None
    bounds = sorted(set(found or []))
    bucket = _bucket(F.col("doc_id"), bounds)
    heads = sorted(base.groupBy(bucket.alias("b")).agg(F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect(), key=lambda r: r["b"])
    # the first document of a bucket goes to the bucket before it as well; few rows, one per bucket
    guests = [(heads[i - 1]["b"], None if r["nulls"] else r["least"]) for i, r in enumerate(heads)]
    first = spark.createDataFrame(guests, f"b int, head {base.schema['doc_id'].dataType.simpleString()}")
    order = F.struct(F.xxhash64("text").alias("h"), "text")
    guest = base.join(F.broadcast(first), F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("b").agg(F.min(order).alias("o")).select("b", F.lit(None).cast(base.schema["doc_id"].dataType).alias("doc_id"), "o.text", F.lit(1).alias("guest"))
    own = base.select(bucket.cast("int").alias("b"), "doc_id", "text", F.lit(0).alias("guest"))
    both = add(own.unionByName(guest))
    more = [c for c in both.columns if c not in ("b", "doc_id", "guest")]
    w = Window.partitionBy("b").orderBy("guest", "doc_id", F.xxhash64("text"))
    paired = both.select("b", "doc_id", "guest", *more, F.lead(F.struct(*more)).over(w).alias("next")).filter("guest = 0")
    return paired.select("doc_id", *more, *(F.col(f"next.{c}").alias(f"next_{c}") for c in more))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, marks): (hash, position) of each chosen gram of each whole text. Null text: none."""
    base = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return with_marks(base, "text", "marks").select("doc_id", positions(F.col("marks")).alias("marks"))


def neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document, its edited text and the next document, compared.

    The edited text is the first half of a text (the larger one) and as many code
    points of the next document's beginning as were cut. Null text: empty. Equal
    texts have equal fingerprints, empty ones are alike. Repeated rows follow one
    another. Empty table: no rows. Other columns aren't looked at.
    """
    paired = with_next(docs, lambda df: with_marks(df, "text", "marks").withColumn("marks", hashes(F.col("marks"))), id, text)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = paired.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)).alias("edited"),
        "marks",
        "next_marks",
    )
    done = with_marks(edited, "edited", "edited_marks").withColumn("edited_marks", hashes(F.col("edited_marks")))
    done = with_likeness(with_likeness(done, "marks", "edited_marks", "near_edited"), "marks", "next_marks", "near_next")
    return done.select("doc_id", "n_chars", "edited", "marks", "edited_marks", "near_edited", "near_next")


def as_hex(marks: str) -> Column:
    """Hashes as one string of eight hex digits each."""
    return F.lower(F.array_join(F.transform(marks, lambda h: F.lpad(F.hex(h), 8, "0")), ""))
