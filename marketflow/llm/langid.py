"""Language identification by string kernels: n-gram presence, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from marketflow.llm.common import crc_of_id

#: n-grams of these lengths are blended into one spectrum.
ORDERS = (1, 2, 3, 4)
#: n-grams are hashed to so many features.
FEATURES = 1 << 14
#: Rows multiplied at once.
BATCH = 256
#: Characters whose n-grams are marked at once; bounds a task's memory on very long texts.
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each code point its lower-case letter, or a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def presence(text: str) -> np.ndarray:
    """Which hashed n-grams of the whole text occur: FEATURES booleans.

    The text is folded to lower-case letters and single spaces first; words are
    enclosed by spaces, so that their beginnings and ends count too.
    """
    seen = np.zeros(FEATURES, bool)
    keep = max(ORDERS) - 1
    tail = np.array([32], np.uint32)
    for at in range(0, len(text) + 1, CHUNK):
        part = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.concatenate([tail, _folded()[part], np.array([32], np.uint32) if at + CHUNK > len(text) else part[:0]])
        blank = codes == 32
        codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
        hashed = np.zeros(len(codes), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(codes) < n:
                break
            hashed = hashed[: len(codes) - n + 1] * np.uint32(0x01000193) + (codes[n - 1 :] + np.uint32(1)) * np.uint32(0x9E3779B1)
            if n in ORDERS:
                seen[(hashed * np.uint32(0x85EBCA6B)) >> np.uint32(18)] = True
        tail = codes[-keep:]
    return seen


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel: shared n-grams over the geometric mean of both counts."""
    a, b = rows.astype(np.float32), landmarks.astype(np.float32)
    norm = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))[None, :]
    return (a @ b.T) / norm


@dataclass
class Model:
    """Landmarks, and for each language the weights of the kernels with them."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def margins(self, rows: np.ndarray) -> np.ndarray:
        return kernel(rows, self.landmarks) @ self.weights + self.bias


def fit(rows: np.ndarray, labels: list[str], per_language: int = 24, ridge: float = 1e-3) -> Model:
    """One-versus-rest kernel ridge regression on Nyström features.

    Landmarks are the first ``per_language`` rows of each language. The kernel
    matrix of the landmarks, its small eigenvalues cut, gives the feature map; in
    it each language is a ridge regression onto +1 and -1, rows weighted so that
    every language counts alike.
    """
    languages = sorted(set(labels))
    names = np.array(labels)
    chosen = np.concatenate([np.nonzero(names == x)[0][:per_language] for x in languages])
    landmarks = rows[chosen]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    good = values > 1e-6 * values.max()
    to_features = vectors[:, good] / np.sqrt(values[good])
    x = kernel(rows, landmarks) @ to_features
    y = np.where(names[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    weight = np.array([1.0 / (len(languages) * (names == n).sum()) for n in labels])
    mean_x, mean_y = weight @ x, weight @ y
    xc, yc = x - mean_x, y - mean_y
    beta = np.linalg.solve(xc.T @ (xc * weight[:, None]) + ridge * np.eye(x.shape[1]), xc.T @ (yc * weight[:, None]))
    return Model(languages, landmarks, (to_features @ beta).astype(np.float32), (mean_y - mean_x @ beta).astype(np.float32))


def train(
    docs: DataFrame, usable: Column, per_language: int = 400, landmarks: int = 24, languages: int = 256, id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model | None:
    """Fit on at most ``per_language`` labelled rows of each of the ``languages`` most frequent languages; None if there are none.

    The rows are those of least hash of their id among rows where ``usable`` holds
    and lang and text aren't null, so that the choice is the same in every run.
    Each language is counted first; its count gives the hash below which about
    twice as many rows lie as are asked for, and only those are moved and
    ordered. Only their presence bits (2 KB a row) come to the driver.
    """
    labelled = docs.select(F.col(id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"), usable.alias("u"))
    labelled = labelled.filter("u AND lang IS NOT NULL AND text IS NOT NULL").drop("u")
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not counts:
        return None
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], 1.0 if r["n"] <= 4 * per_language else 2.0 * per_language / r["n"])))
    low = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.try_element_at(share, F.col("lang")) * (1 << 40)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    picked = labelled.filter(low).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.packbits(presence(t.as_py())).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "lang", "bits"])

    got = picked.select(F.col("doc_id").cast("string"), "lang", "text").mapInArrow(bits, "doc_id string, lang string, bits binary").collect()
    got = sorted(got, key=lambda r: (r["lang"], r["bits"], str(r["doc_id"])))
    if not got:
        return None
    taken: dict[str, list[bytes]] = {}
    for r in got:
        taken.setdefault(r["lang"], []).append(bytes(r["bits"]))
    rows = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for own in taken.values() for b in own], bool)
    return fit(rows, [x for x, own in taken.items() for _ in own], landmarks)


def identify(docs: DataFrame, model: Model | None, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` and lang_pred, score, claim of each row's whole text.

    The score is the best margin's share: margins are mapped from -1..1 to 0..1
    and divided by their sum. The claim is the best margin so mapped, by itself: it
    doesn't fall as languages are added, and 0.5 is where a language's regression
    takes the text for its own as much as for another's. Equal margins go to the
    first language in order; texts of any length count whole. A null text or one without a letter is ``und`` with
    score 0, and so is all if there was nothing to learn from. Texts are scored
    in batches, by one matrix product each.
    """
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    source = docs.select(*keep, F.when(letters, F.col(text)).alias("__text"))
    schema = StructType([*source.schema.fields[:-1], StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("claim", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                texts = part.column(part.num_columns - 1)
                known = [i for i in range(part.num_rows) if m is not None and texts[i].is_valid]
                best, value, claim = ["und"] * part.num_rows, [0.0] * part.num_rows, [0.0] * part.num_rows
                if known:
                    p = np.clip((m.margins(np.array([presence(texts[i].as_py()) for i in known])) + 1) / 2, 0, 1).astype(np.float64)
                    top, total = p.argmax(1), p.sum(1)
                    for i, k, t, row in zip(known, top, total, p):
                        best[i] = m.languages[k]
                        value[i] = float(row[k] / t) if t > 0 else 0.0
                        claim[i] = float(row[k])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(best, pa.string()), pa.array(value, pa.float64()), pa.array(claim, pa.float64())],
                    names=[*part.schema.names[:-1], "lang_pred", "score", "claim"],
                )

    return source.mapInArrow(score, schema)


def held_out() -> Column:
    """Whether a document is kept from learning: crc32 of its id mod 4 is 2. Not so for a null id."""
    return F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(4)) == 2, F.lit(False))


def language_id(docs: DataFrame, per_language: int = 400, landmarks: int = 24) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document.

    Learns from text and lang of documents that aren't held out (a null id is
    neither held out nor learned from). Repeated rows come out as often as they
    came in; an empty table gives no rows.
    """
    model = train(docs, F.col("doc_id").isNotNull() & ~held_out(), per_language, landmarks)
    found = identify(docs, model, [F.col("doc_id")])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
