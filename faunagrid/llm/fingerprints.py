"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed from the left into dictionary phrases: each phrase is the shortest string
from the current place that is not yet in the dictionary, and joins it. Texts that compress
well together share many phrases. The set of phrase hashes is summarised by a minimum-hash
signature with one permutation: each of ``BINS`` bins keeps the smallest hash that falls into it.
The likeness of two fingerprints is the share of equal bins among those that either fills.

Defined cases: a null text counts as empty; the empty text has an empty fingerprint, whose
likeness is 1 to itself and 0 to any other; equal texts have equal fingerprints; rows with a
null id come first in the order; equal ids are ordered by a hash of the text, then the text; the
single row of a table is its own next; ids are of any type that Spark can order; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from faunagrid.llm.storage import arrow_map, stored, table

BINS = 128


#: Bits of a hash that name its bin; a bin that nothing has fallen into, as a hash and as written.
BIN_BITS = BINS.bit_length() - 1
EMPTY, NONE = np.uint64((1 << 64) - 1), (1 << 16) - 1


def phrases(text: str, known: set[str]) -> tuple[list[str], str]:
    """The phrases of ``text``, which join ``known``, and the unfinished rest, which is in it or empty."""
    found: list[str] = []
    add, out, phrase = known.add, found.append, ""
    for c in text:
        phrase += c
        if phrase not in known:
            add(phrase)
            out(phrase)
            phrase = ""
    return found, phrase


def lowered(bins: np.ndarray, found: list[str]) -> np.ndarray:
    """The bins after the hashes of further phrases."""
    bins = bins.copy()
    hashes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    np.minimum.at(bins, (hashes & np.uint64(BINS - 1)).astype(np.int64), hashes >> np.uint64(BIN_BITS))
    return bins


def none() -> np.ndarray:
    return np.full(BINS, EMPTY)


def coded(bins: np.ndarray) -> np.ndarray:
    """Smallest hashes as 16 bits: how many zeros lead, and the 10 bits after the first one.

    However many phrases a text has, and so however small its hashes are, two unlike ones have the same code by a chance below 1 in 1000.
    """
    part, power = np.frexp(np.maximum(bins, np.uint64(1)).astype(np.float64))
    code = (64 - BIN_BITS - power).astype(np.int64) << 10 | ((part - 0.5) * 2048).astype(np.int64)
    return np.where(bins == EMPTY, NONE, code)


def written(bins: np.ndarray) -> bytes:
    """Two bytes a bin; nothing for the empty text."""
    return b"" if (bins == EMPTY).all() else coded(bins).astype(">u2").tobytes()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = coded(a), coded(b)
    either = (a < NONE) | (b < NONE)
    return float(((a == b) & either).sum() / either.sum()) if either.any() else 1.0


def fingerprint(text: str) -> np.ndarray:
    return lowered(none(), phrases(text, set())[0])


def fingerprints(df: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``df`` with each text's fingerprint."""

    @F.arrow_udf(T.StringType())
    def made(texts: pa.Array) -> pa.Array:
        return pa.array((written(fingerprint(x or "")).hex() for x in texts.to_pylist()), pa.string())

    return df.withColumn(into, made(F.coalesce(F.col(text), F.lit(""))))


def edited(text: str, following: str) -> tuple[int, str]:
    """How much of ``text`` stays, and the edited text: its last quarter replaced by the start of the next."""
    part = len(text) // 4
    return len(text) - part, text[: len(text) - part] + following[:part]


def compare(text: str, following: str) -> tuple[np.ndarray, tuple]:
    """The text's own bins, and its row without id and near_next."""
    stays, other = edited(text, following)
    known: set[str] = set()
    found, rest = phrases(text[:stays], known)  # common to both texts
    common = lowered(none(), found)
    also = set(known)
    bins = lowered(common, phrases(rest + text[stays:], known)[0])
    other_bins = lowered(common, phrases(rest + other[stays:], also)[0])
    return bins, (len(text), hashlib.sha256(other.encode()).digest(), written(bins), written(other_bins), likeness(bins, other_bins))


#: Parts that equal texts of one id can be dealt to.
SPREAD = 1 << 14
FIELDS = [("n_chars", T.LongType()), ("edited_sha256", T.BinaryType()), ("fingerprint", T.BinaryType()), ("edited_fingerprint", T.BinaryType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]


def rows_schema(key: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(x, t) for x, t in [("id", key), *FIELDS]])


def ends_schema(key: T.DataType) -> T.StructType:
    """What a range of ids yields: rows, and the texts of its first and its last document."""
    return T.StructType([T.StructField("part", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), *rows_schema(key).fields])


def batches_of(rows: list[tuple], schema: T.StructType, size: int = 1000) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    for i in range(0, len(rows), size):
        columns = zip(*rows[i : i + size], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def compare_in_order(batches: Iterator[pa.RecordBatch], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows of one range, in order; the last waits for the first document of the next range."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    held = None  # id and text of the document before
    waiting = None  # its predecessor's row, which lacks only near_next
    first = None
    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if held is None:
                first = text
            else:
                bins, row = compare(held[1], text)
                if waiting:
                    out.append((part, "row", None, *waiting[0], likeness(waiting[1], bins)))
                waiting = ((held[0], *row), bins)
            held = key, text
        yield from batches_of(out, schema)
        out = []
    if held:
        if waiting:
            out.append((part, "row", None, *waiting[0], likeness(waiting[1], fingerprint(held[1]))))
        nothing = (None,) * len(FIELDS)
        out += [(part, "head", first, None, *nothing), (part, "tail", held[1], held[0], *nothing)]
        yield from batches_of(out, schema)


def compare_ends(batches: Iterator[pa.RecordBatch], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bins, row = compare(text, following)
            out.append((key, *row, likeness(bins, fingerprint(following))))
        yield from batches_of(out, schema)


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against its edited text and against the next document in the order of ``key``.

    Documents are dealt once, by ranges of the key, and each range is read in order. A range's
    last document meets the first of the next range that has any in a join of the two ends. A key
    that very many rows share is dealt by their texts' hashes, and equal texts of it, whose order
    makes no difference, by their places in the input.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType
    ends, plain = ends_schema(kind), rows_schema(kind)
    rows = df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("spread", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD)).cast("short"))
    ranges = rows.repartitionByRange("id", "hash", "spread").sortWithinPartitions("id", "hash", "text").select("id", "text")
    done = stored(arrow_map(ranges, lambda batches: compare_in_order(batches, ends), ends), "fingerprints")
    heads, tails = (done.where(F.col("role") == role) for role in ("head", "tail"))
    parts = sorted(x.part for x in heads.select("part").collect())  # at most the number of partitions
    order = spark.createDataFrame([*zip(parts, parts[1:] + parts[:1], strict=True)], "part int, follower int")
    pairs = tails.select("part", "id", "text").join(order, "part").join(heads.select(F.col("part").alias("follower"), F.col("text").alias("following")), "follower")
    last = arrow_map(pairs.select("id", "text", "following"), lambda batches: compare_ends(batches, plain), plain)
    every = done.where(F.col("role") == "row").select(*plain.names).unionByName(last)
    texts = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return every.withColumns(texts).withColumnRenamed("id", key)


def op10_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(table(spark, sf_dir, "documents"))
