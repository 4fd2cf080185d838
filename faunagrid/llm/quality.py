"""Quality classifier by compression with dictionaries of good and of bad text.

Two zstandard dictionaries are built, one from each label. A text is cut into pieces (all of
it), and every piece is compressed with either dictionary. The difference of the two sizes, over the
length of the text, tells which label it is like, and the smaller of them how repetitive
it is; logistic regression over both, fitted on labelled rows that the dictionaries have not
seen, turns them into a score between 0 and 1.

Fitting takes a bounded sample: ``FIT_ROWS`` labelled rows, the first by a hash of their id, and
``FIT_CHARS`` code points of each at most. Scoring reads whole texts.

Defined cases: a null text counts as empty, and gets the score that the model gives to size 0;
rows with null ids or labels are not learned from; of repeated labels of one id the largest
counts; without rows of both labels every score is the share of label 1 (0.5 without any row);
output columns replace input columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunagrid.llm.storage import arrow_map, table

FIT_ROWS = 6000
FIT_CHARS = 20_000
PIECE = 1024
LEVEL = 3
DICTIONARY = 112_640
THRESHOLD = 0.3
FOLDS = 5


def held_out(key: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves no remainder by 5."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0


def pieces(data: bytes) -> list[bytes]:
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)] or [b""]


def dictionary(texts: list[bytes]) -> bytes:
    """Dictionary content from samples; from few of them, the samples themselves."""
    samples = [x for text in texts for x in pieces(text) if len(x) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(samples)[:DICTIONARY]


@dataclass
class Model:
    """Dictionaries and calibration; small, so that it travels with the task."""

    good: bytes = b""
    bad: bytes = b""
    weights: list[float] = field(default_factory=list)
    constant: float = 0.5

    def compressors(self) -> tuple:
        made = []
        for content in (self.good, self.bad):
            held = zstandard.ZstdCompressionDict(content)
            held.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        return tuple(made)

    @staticmethod
    def features(data: bytes, good, bad) -> tuple[float, float]:
        as_good = as_bad = 0
        for piece in pieces(data):
            as_good += len(good(piece))
            as_bad += len(bad(piece))
        n = max(1, len(data))
        return (as_good - as_bad) / n, min(as_good, as_bad) / n

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.constant)
        good, bad = self.compressors()
        found = np.array([self.features(x, good, bad) for x in texts]).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(terms(found) @ np.array(self.weights), -30, 30)))


def terms(found: np.ndarray) -> np.ndarray:
    """The features on a common scale, with a constant. Size 0 must not be far from the others."""
    return np.stack([np.ones(len(found)), np.clip(found[:, 0] * 20, -8, 8), np.clip(found[:, 1] * 10, 0, 15)], 1)


def calibrated(found: np.ndarray, labels: np.ndarray) -> list[float]:
    """Logistic regression by Newton's method, slightly regularised."""
    x, w = terms(found), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(hessian, x.T @ (labels - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def sampled(text: Column) -> Column:
    """A text of up to FIT_CHARS code points, or as many of a longer one in pieces taken evenly from its start to its end."""
    last = FIT_CHARS // PIECE - 1
    start = lambda i: F.floor(i * (F.char_length(text) - PIECE) / last).cast("int") + 1
    parts = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda i: F.substring(text, start(i), F.lit(PIECE)))
    return F.when(F.char_length(text) <= FIT_CHARS, text).otherwise(F.concat_ws("", parts))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """Dictionaries from samples of half of the labelled texts, calibrated on the whole texts of the other half."""
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL").where(~held_out("id"))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    held = texts.join(F.broadcast(chosen), "id")
    found = held.withColumn("text", sampled(F.col("text"))).collect()  # bounded by rows * FIT_CHARS
    found.sort(key=lambda r: (hash_order(r.id), r.text))
    half = {r.id for r in found[: len(found) // 2]}
    by = [[r.text.encode() for r in found if r.id in half and (r.label == 1) == side] for side in (True, False)]
    others = {r.id: r.label for r in found if r.id not in half}
    if not all(by) or len({x == 1 for x in others.values()}) < 2:
        return Model(constant=float(np.mean([r.label == 1 for r in found])) if found else 0.5)
    model = Model(dictionary(by[0]), dictionary(by[1]))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = model.compressors()
        for batch in batches:
            pairs = [model.features(x, good, bad) for x in batch.column("text").cast(pa.binary()).to_pylist()]
            a, b = np.array(pairs, float).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(a), pa.array(b)], ["label", "a", "b"])

    rest = docs.sparkSession.createDataFrame([*others.items()], chosen.schema)
    whole = sorted(arrow_map(texts.join(F.broadcast(rest), "id").select("label", "text"), measured, "label int, a double, b double").collect())
    model.weights = calibrated(np.array([(r.a, r.b) for r in whole]), np.array([r.label == 1 for r in whole], float))
    return model


def hash_order(key: object) -> int:
    """An order of ids that has nothing to do with their values."""
    import zlib

    return zlib.crc32(f"order {key}".encode())


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1, higher: label 1 likelier)."""
    df = df.drop("score")
    at = df.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(texts), pa.float64())], [*batch.schema.names, "score"])

    return arrow_map(df, scored, T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType())]))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    found = score(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
