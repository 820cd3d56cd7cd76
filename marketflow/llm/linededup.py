"""Line dedup by a log-template tree, in Spark expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import stored
from marketflow.llm.winnowing import UNSPACED

#: Tokens on a line's path: the tree branches by token count, then by these.
LEADING = 3
#: Parts of the rest of a line, one of which may vary.
SEGMENTS = 4
#: Lines of fewer tokens are templates only from LEAST_CHARS characters on; under the second, only whole lines are.
LEAST_TOKENS, LEAST_VARIABLE, LEAST_CHARS = 4, 8, 16
#: A context orders tokens by length (up to the limit), then by this many bits of their MD5.
LENGTH_LIMIT, MD5_BITS = (1 << 22) - 1, 40
#: A text bears witness for a template if its rarer lines make up one token in so many.
OWN = 8


def masked(line: Column) -> Column:
    """A line with its tokens that hold a digit masked, and single spaces."""
    variable = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(^|[ \t\r\f])[^ \t\r\f0-9]*+[0-9][^ \t\r\f]*+", "$1<*>")).otherwise(line)
    spaced = F.contains(line, F.lit("  "))
    for blank in "\t\r\f":
        spaced = spaced | F.contains(line, F.lit(blank))
    return F.trim(F.when(spaced, F.regexp_replace(variable, r"[ \t\r\f]+", " ")).otherwise(variable))


def _let(value: Column, use) -> Column:
    """``use(value)``, where the value is computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _templates(tokens: Column, chars: Column) -> Column:
    """Keys of the templates that a line (as tokens) may belong to.

    The key holds the path (token count, leading tokens) and the constant tokens.
    The first template is the whole masked line. Each of the others leaves out one
    of SEGMENTS parts behind the leading tokens, as a variable field. A token is
    hashed once, in its part; keys are hashes of the parts' hashes.
    """
    n = F.size(tokens)
    rest = n - LEADING
    ends = [F.floor(rest * i / SEGMENTS).cast("int") + LEADING for i in range(SEGMENTS + 1)]
    parts = [F.slice(tokens, 1, LEADING), *(F.slice(tokens, ends[i] + 1, ends[i + 1] - ends[i]) for i in range(SEGMENTS))]
    hashed = F.struct(n.alias("n"), *(F.xxhash64(x).alias(f"p{i}") for i, x in enumerate(parts)))

    def keys(h):
        own = [h[f"p{i}"] for i in range(SEGMENTS + 1)]
        return F.array(F.xxhash64(h["n"], F.lit(0), *own), *(F.xxhash64(h["n"], F.lit(i), *(own[:i] + own[i + 1 :])) for i in range(1, SEGMENTS + 1)))

    whole = F.array(F.xxhash64(n, F.lit(0), tokens))
    return F.when(n >= LEAST_VARIABLE, _let(hashed, keys)).when((n >= LEAST_TOKENS) | (chars >= LEAST_CHARS), whole).otherwise(F.array().cast("array<bigint>"))


def _top(tokens: Column) -> Column:
    """The place of a line's longest token (the greatest of equals) in the order of tokens; 0 without tokens."""
    most = F.array_max(F.transform(tokens, F.length))
    longest = _let(most, lambda n: F.array_max(F.filter(tokens, lambda w: F.length(w) == n)))
    number = F.conv(F.substring(F.md5(longest), 1, MD5_BITS // 4), 16, 10).cast("bigint")
    return F.coalesce(F.shiftleft(F.least(most, F.lit(LENGTH_LIMIT)).cast("bigint"), MD5_BITS) + number, F.lit(0).cast("bigint"))


def _level(n: Column) -> Column:
    """The binary digits of a count: a line is rarer than another if it has fewer."""
    return F.length(F.bin(n))


def _two(tops: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(tops), asc=False), 1, 2)


def dedup_lines(docs: DataFrame, min_docs: int = 4, long_tokens: int = 50, long_min_docs: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (all columns), ``clean`` (the text without recurring lines), ``n_lines``, ``n_dropped``.

    Equal texts count once and are treated alike. A line's count is the number of
    texts that its most frequent template occurs in. A text bears witness for a
    template if lines whose counts have fewer binary digits than the template's
    make up an eighth (one in OWN) of its tokens: it has something of its own besides what it
    shares as widely. The two longest tokens of those lines (of different lines)
    are the witness's context. A template recurs if its witnesses have ``min_docs``
    contexts (``long_min_docs`` for lines of ``long_tokens`` tokens) and at least one
    context for four witnesses. Copies and near copies of a document share nearly
    all their lines equally widely, so they bear no witness and neither lose their
    lines to each other nor keep other documents from losing theirs. The lines of
    a block don't hide one another, as they are equally frequent.

    The text of the least id that has a recurring template keeps its lines, so that
    one copy of any passage stays; all others lose theirs. Line breaks are ``\\n``;
    the lines left keep their order and wording.

    Tokens stand between spaces; letters of scripts written without spaces are
    tokens each. Lines of under LEAST_TOKENS tokens and LEAST_CHARS characters stay.

    Only hashes, counts and line numbers are shuffled besides the documents
    themselves. A hot template is counted with partial sums and its join may be
    split; copies of a text meet in partial aggregates.

    Null text stays null, without lines. A row without an id counts and
    keeps its lines. Rows that repeat an id are judged by their texts. Empty
    table: no rows.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    base = docs.select(F.col(f"`{id}`").alias("doc"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    # letters of unspaced scripts stand alone
    apart = _let(F.col("text"), lambda t: F.when(t.rlike(f"[{UNSPACED}]"), F.regexp_replace(t, f"([{UNSPACED}])", " $1 ")).otherwise(t))
    lines = base.select("doc", F.xxhash64("text").alias("d"), F.transform(F.split(apart, "\n", -1), masked).alias("lines"))
    lines = lines.withColumn("lines", F.transform("lines", lambda x: F.struct(F.length(x).alias("chars"), F.filter(F.split(x, " "), lambda w: w != "").alias("t"))))

    def measured(x):
        return F.struct(_templates(x["t"], x["chars"]).alias("keys"), F.size(x["t"]).alias("n"), _top(x["t"]).alias("top"))

    hashed = stored(lines.select("doc", "d", F.transform("lines", measured).alias("lines")), "line_keys")
    placed = hashed.select("d", F.posexplode("lines").alias("line", "x")).select("d", "line", "x.n", "x.top", F.explode("x.keys").alias("key"))
    shared = placed.groupBy("key").agg(F.countDistinct("d").alias("texts")).filter("texts > 1").select("key", _level(F.col("texts")).alias("level"))
    hits = placed.join(shared, "key").select("d", F.struct("line", "level", "key", "n", "top").alias("x")).groupBy("d").agg(F.sort_array(F.collect_set("x")).alias("hits"))
    tops = F.transform("lines", lambda x, i: F.struct(i.alias("line"), x["top"].alias("top")))
    whole = hashed.select("doc", "d", F.aggregate("lines", F.lit(0), lambda a, x: a + x["n"]).alias("total"), tops.alias("tops"))
    whole = whole.groupBy("d").agg(F.min("doc").alias("doc"), F.max("total").alias("total"), F.first("tops").alias("tops"))
    # of each line its most frequent template, which sorts last
    widest = F.filter("hits", lambda x, i: ~F.coalesce(F.get(F.col("hits"), i + 1)["line"] == x["line"], F.lit(False)))

    def contexts(v):
        # v holds the values that every level uses, computed once
        def rarer(level):
            weight = F.col("total") - F.aggregate(v["widest"], F.lit(0), lambda a, x: a + F.when(x["level"] >= level, x["n"]).otherwise(0))
            rare = F.transform(F.filter(v["widest"], lambda x: x["level"] < level), lambda x: x["top"])
            return F.when(weight * OWN >= F.col("total"), F.xxhash64(_two(F.concat(v["own"], rare))))

        return F.transform(F.sequence(F.lit(1), F.array_max(F.transform(v["widest"], lambda x: x["level"]))), rarer)

    def with_own(w):
        own = F.array_except("tops", F.transform(w, lambda x: F.struct(x["line"].alias("line"), x["top"].alias("top"))))
        return F.struct(w.alias("widest"), _two(F.transform(own, lambda x: x["top"])).alias("own"))

    near = hits.join(whole, "d").select("d", "doc", "hits", _let(_let(widest, with_own), contexts).alias("contexts"))
    def judged(contexts):
        return F.transform("hits", lambda x: F.struct(x["line"].alias("line"), x["key"].alias("key"), (x["n"] >= long_tokens).alias("long"), F.get(contexts, x["level"] - 1).alias("context")))

    near = stored(near.select("d", "doc", _let(F.col("contexts"), judged).alias("hits")), "line_hits")

    once = F.array_distinct(F.transform("hits", lambda x: F.struct(x["key"].alias("key"), x["long"].alias("long"), x["context"].alias("context"))))
    first = F.struct(F.col("doc").isNull().alias("none"), "doc", "d").alias("first")
    by_context = near.select(first, F.explode(once).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"))
    witnessed = F.col("k.context").isNotNull()
    counted = by_context.groupBy("k.key", "k.long").agg(
        F.count(F.when(witnessed, 1)).alias("contexts"), F.sum(F.when(witnessed, F.col("texts"))).alias("witnesses"), F.min("first").alias("first")
    )
    enough = (F.col("contexts") >= F.when(F.col("long"), long_min_docs).otherwise(min_docs)) & (F.col("contexts") * 4 >= F.col("witnesses"))
    recurring = counted.filter(enough).select("key", F.col("first.d").alias("first"))
    gone = near.select("d", F.explode("hits").alias("x")).select("d", "x.line", "x.key").join(recurring, "key").filter("d != first").groupBy("d").agg(F.collect_set("line").alias("gone"))
    # each text travels once, inside its row
    joined = docs.select(row, F.when(F.col(f"`{id}`").isNotNull(), F.xxhash64(F.col(f"`{text}`"))).alias("d")).join(gone, "d", "left")
    joined = joined.withColumn("text", F.col(f"row.`{text}`")).withColumn("all", F.split("text", "\n", -1))
    places = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), "gone")
    kept_lines = F.array_join(F.transform(places, lambda i: F.get(F.col("all"), i)), "\n")
    clean = F.when(F.col("gone").isNull() | F.col("text").isNull(), F.col("text")).otherwise(kept_lines)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("all"))
    n_dropped = F.when(F.col("text").isNull() | F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    return joined.select("row", clean.alias("clean"), n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def clean(docs: DataFrame, text: str = "text", length: str = "n_chars", **options) -> DataFrame:
    """The documents without recurring lines, with all their columns; ``length``, if there, is counted anew."""
    found = dedup_lines(docs, text=text, **options)
    made = {text: F.col("clean"), length: F.length("clean").cast(docs.schema[length].dataType) if length in docs.columns else None}
    return found.select(*((made[c] if c in made else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


# The same in SQL. Keys are the template strings themselves, contexts the lists of tokens' places.
_LETTER = re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", UNSPACED)
SQL = f"""
WITH texts AS (SELECT text, row_number() OVER (ORDER BY min(doc_id) NULLS LAST, text) AS d FROM documents WHERE text IS NOT NULL GROUP BY text),
lines AS (SELECT d, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM texts),
clear AS (
  SELECT d, pos, line, trim(regexp_replace(regexp_replace(regexp_replace(line, '([{_LETTER}])', ' \\1 ', 'g'),
    '(^|[ \\t\\r\\f])[^ \\t\\r\\f0-9]*[0-9][^ \\t\\r\\f]*', '\\1<*>', 'g'), '[ \\t\\r\\f]+', ' ', 'g'), ' ') AS m
  FROM lines),
tok AS (SELECT d, pos, length(m) AS chars, list_filter(string_split(m, ' '), lambda w: w != '') AS t FROM clear),
longest AS (SELECT *, len(t) AS n, list_max([{{'n': length(w), 'w': w}} for w in t]) AS w FROM tok),
sized AS (
  SELECT d, pos, chars, t, n, coalesce(least(w.n, {LENGTH_LIMIT}) * {1 << MD5_BITS} + CAST('0x' || substr(md5(w.w), 1, {MD5_BITS // 4}) AS BIGINT), 0) AS top FROM longest),
keys AS (
  SELECT d, pos, n, top, n || '|0|' || array_to_string(t, ' ') AS key FROM sized WHERE n >= {LEAST_TOKENS} OR chars >= {LEAST_CHARS}
  UNION ALL
  SELECT d, pos, n, top, n || '|' || (i + 1) || '|' || array_to_string(t[1:a], ' ') || '|' || array_to_string(t[b + 1:n], ' ') AS key
  FROM (SELECT *, {LEADING} + (n - {LEADING}) * i // {SEGMENTS} AS a, {LEADING} + (n - {LEADING}) * (i + 1) // {SEGMENTS} AS b
        FROM sized, range({SEGMENTS}) AS s(i) WHERE n >= {LEAST_VARIABLE})),
shared AS (SELECT key, count(DISTINCT d) AS texts FROM keys GROUP BY key HAVING count(DISTINCT d) > 1),
hits AS (SELECT d, pos, n, key, length(bin(texts)) AS level FROM keys JOIN shared USING (key)),
ranked AS (SELECT s.d, s.pos, s.n, s.top, coalesce(h.level, 1) AS level FROM sized s LEFT JOIN (SELECT d, pos, max(level) AS level FROM hits GROUP BY 1, 2) h USING (d, pos)),
totals AS (SELECT d, sum(n) AS total FROM sized GROUP BY d),
asked AS (SELECT DISTINCT d, level FROM hits),
contexts AS (
  SELECT a.d, a.level, list_slice(list_reverse_sort(list_distinct(list(r.top) FILTER (WHERE r.level < a.level))), 1, 2) AS context
  FROM asked a JOIN ranked r USING (d) JOIN totals t USING (d)
  GROUP BY a.d, a.level HAVING {OWN} * coalesce(sum(r.n) FILTER (WHERE r.level < a.level), 0) >= any_value(t.total)),
counted AS (
  SELECT key, count(DISTINCT context) AS contexts, count(DISTINCT CASE WHEN context IS NOT NULL THEN d END) AS witnesses, min(d) AS first, max(n) AS n
  FROM hits LEFT JOIN contexts USING (d, level) GROUP BY key),
recurring AS (SELECT key, first FROM counted WHERE contexts >= CASE WHEN n >= 50 THEN 2 ELSE 4 END AND 4 * contexts >= witnesses),
gone AS (SELECT DISTINCT d, pos FROM hits JOIN recurring USING (key) WHERE d != first),
put AS (
  SELECT b.d, string_agg(b.line, chr(10) ORDER BY b.pos) FILTER (WHERE g.pos IS NULL) AS text, count(*) AS n_lines, count(g.pos) AS n_dropped
  FROM lines b LEFT JOIN gone g USING (d, pos) GROUP BY b.d)
SELECT o.doc_id, CASE WHEN o.doc_id IS NULL THEN o.text WHEN o.text IS NOT NULL THEN coalesce(p.text, '') END AS text,
  coalesce(p.n_lines, 0) AS n_lines, CASE WHEN o.doc_id IS NULL THEN 0 ELSE coalesce(p.n_dropped, 0) END AS n_dropped
FROM documents o LEFT JOIN texts t ON o.text = t.text LEFT JOIN put p ON t.d = p.d
"""
