"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at either end, A-Z lower-cased; its hash has
128 bits. The store is a list of levels of runs; a run is a table of one row per key, in buckets by hash,
each of which is one file sorted by hash. All runs have the same buckets, so that bringing runs
together is a merge of sorted files, bucket by bucket: nothing of a run is dealt or sorted again.
Each new batch of documents is summarised by key, merge-anti-joined with
the runs (the keys left over are new, and their largest document keeps the line) and added as
a run of its own; a level with ``fan_out`` runs is compacted into one run of the next level.
Batches come in descending order of document id, so that the keeper of a key is the largest
document that holds it; their number grows with the logarithm of the number of lines.

Defined cases: a null or empty text is one empty line; a row with a null id is returned with
all its lines and counts for no key; rows with the same id are one document (a key dropped in
it is dropped in all its rows); ids of other types than whole numbers are numbered in their order
first; output columns replace input columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunagrid.llm.storage import arrow_map, drop_path, dropped, new_path, stored, table, with_long

WHITE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
#: Lines of a first batch, at about; with each doubling of all lines there is one batch more.
BATCH_LINES = 1 << 19
FAN_OUT = 2
#: Documents of one line that one task looks at; a line of more is dealt to several.
HOT = 4096
#: With this setting, a table of sorted buckets of one file each is read in order.
IN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"
HASH = ["h1", "h2"]


def line_hashes(text: bytes, min_chars: int) -> list[bytes | None]:
    """For each line the 16-byte hash of its key, or None for a key that is too short."""
    out = []
    for line in text.lower().split(b"\n"):  # bytes.lower() changes A-Z only
        key = line.strip(WHITE)
        n = len(key)
        if n < min_chars or n < 4 * min_chars and len(key.decode(errors="replace")) < min_chars:
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(key))
    return out


def texts_of(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def key_table(df: DataFrame, doc: str, text: str, min_chars: int) -> DataFrame:
    """A row (doc, h1, h2) for each row of ``df`` and each different key in it."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [], []
            for data in texts_of(batch.column(1)):
                own = {x for x in line_hashes(data, min_chars) if x}
                counts.append(len(own))
                found += own
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            at = np.repeat(np.arange(len(counts)), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["doc", *HASH])

    rows = df.select(F.col(doc).alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    return arrow_map(rows, keys, "doc long, h1 long, h2 long")


class LineRuns:
    """The levels. Every run is on shared storage, so that no step depends on an executor's memory."""

    COLUMNS = [*HASH, "n_docs", "keeper"]

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT, buckets: int | None = None) -> None:
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}
        self.before = spark.conf.get(IN_ORDER)
        spark.conf.set(IN_ORDER, "true")

    def names(self) -> list[str]:
        return [x for level in self.levels for x in level]

    def add(self, batch: DataFrame) -> None:
        """Adds the keys (doc, h1, h2) of documents smaller than all those before."""
        own = batch.groupBy(*HASH).agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("keeper"))
        for i, name in enumerate(self.names()):
            known = self.spark.table(name).where("keeper IS NOT NULL").select(*HASH, F.lit(True).alias(f"known{i}"))
            own = own.join(known.hint("merge"), HASH, "left")
        known = F.coalesce(*(F.col(f"known{i}") for i in range(len(self.names()))), F.lit(False))
        self.write(own.withColumn("keeper", F.when(~known, F.col("keeper"))), 0)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fan_out:
                self.compact(level)

    def write(self, rows: DataFrame, level: int) -> None:
        path = new_path(self.spark, "run")
        name = path.rpartition("/")[2].replace("-", "_")
        rows.select(*self.COLUMNS).write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        self.paths[name] = path
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def compact(self, level: int) -> None:
        """Makes one run of the next level of all runs of a level, two at a time."""
        while len(self.levels[level]) > 2:
            a, b, *rest = self.levels[level]
            self.levels[level] = rest
            self.merge(a, b, level)
        a, b = self.levels[level]
        self.levels[level] = []
        self.merge(a, b, level + 1)

    def merge(self, a: str, b: str, level: int) -> None:
        self.write(self.merged(a, b), level)
        self.drop(a)
        self.drop(b)

    def merged(self, a: str, b: str) -> DataFrame:
        """Two runs as one, by a merge of their sorted buckets. (A union of them must not be grouped without dealing it again: Spark 4.1
        holds that it keeps their buckets, but reads columns of one after the other.)"""
        x, y = (self.spark.table(name).withColumnsRenamed({"n_docs": f"n{i}", "keeper": f"k{i}"}) for i, name in enumerate((a, b)))
        both = x.hint("merge").join(y, HASH, "full")
        return both.select(*HASH, (F.coalesce("n0", F.lit(0)) + F.coalesce("n1", F.lit(0))).alias("n_docs"), F.greatest("k0", "k1").alias("keeper"))

    def verdicts(self) -> DataFrame:
        """One row per key: in how many documents it is, and which keeps it. Brings all runs together, smaller ones first."""
        while len(self.names()) > 1:
            a, b, *rest = self.names()
            self.levels = [[], rest]
            self.merge(a, b, 0)
        return self.spark.table(self.names()[0])

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(self.spark, self.paths.pop(name))

    def close(self) -> None:
        """Removes all runs."""
        for name in [*self.paths]:
            self.drop(name)
        self.spark.conf.set(IN_ORDER, self.before)


def repeated(df: DataFrame, doc: str, text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None) -> DataFrame:
    """For each document (``doc``: a whole number) that loses lines: ``doc``, and ``drops``, the hashes of those keys."""
    keys = stored(key_table(df, doc, text, min_chars), "line-keys")
    if batches is None:
        batches = 1 + (keys.count() // BATCH_LINES).bit_length()
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted({int(x) for x in keys.approxQuantile("doc", shares, 0.01)}, reverse=True) if shares else []
    runs, above = LineRuns(df.sparkSession), None
    try:
        for cut in [*cuts, None]:
            batch = keys if above is None else keys.where(F.col("doc") <= above)
            runs.add(batch if cut is None else batch.where(F.col("doc") > cut))
            above = cut
        over = runs.verdicts().where(F.col("n_docs") >= min_docs).select(*HASH, "keeper", F.ceil(F.col("n_docs") / HOT).cast("int").alias("parts"))
        over = stored(over, "repeated-lines")
    finally:
        runs.close()
    hot = over.where("parts > 1").select(*HASH, "parts")
    salted = keys.join(hot, HASH, "left").withColumn("salt", F.pmod(F.xxhash64("doc"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    dealt = over.select(*HASH, "keeper", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    lost = salted.join(dealt, [*HASH, "salt"]).where(F.col("doc") != F.col("keeper"))
    drops = stored(lost.groupBy("doc").agg(F.collect_set(F.struct(*HASH)).alias("drops")), "line-drops")
    dropped(keys, over)
    return drops


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None) -> DataFrame:
    """``df`` with n_lines, n_dropped and kept_text.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose
    all their lines except in the largest document holding them.
    """
    made = ["n_lines", "n_dropped", "kept_text"]
    df = df.drop(*made)
    numbered = with_long(df, key, "_of")
    drops = repeated(numbered, "_of", text, min_chars, min_docs, batches).withColumnsRenamed({"doc": "_dropped_in", "drops": "_drops"})
    joined = numbered.join(drops, F.col("_of") == F.col("_dropped_in"), "left").drop("_of", "_dropped_in")
    at = df.columns.index(text)
    last = len(df.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for data, drop in zip(texts_of(batch.column(at)), batch.column(last), strict=True):
                lines = data.split(b"\n")
                total.append(len(lines))
                if drop.is_valid and len(drop.values):
                    halves = np.stack([drop.values.field(0).to_numpy(), drop.values.field(1).to_numpy()], 1).astype("<i8")
                    dropped = {x.tobytes() for x in halves}
                    stay = [x for x, h in zip(lines, line_hashes(data, min_chars), strict=True) if h is None or h not in dropped]
                    gone.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay))
                else:
                    gone.append(0)
                    kept.append(data)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], [*batch.schema.names[:last], *made])

    schema = T.StructType([*df.schema.fields, T.StructField(made[0], T.LongType()), T.StructField(made[1], T.LongType()), T.StructField(made[2], T.StringType())])
    return arrow_map(joined, cut, schema)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


#: The white space of a line's ends, for DuckDB.
_ENDS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP7_SQL = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, {_ENDS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), over AS (
    SELECT key, max(doc_id) AS keeper FROM keyed
    WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), judged AS (
    SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS dropped
    FROM keyed LEFT JOIN over USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
