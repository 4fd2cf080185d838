"""Exact top-k search by inner product with a pivot-distance index.

Inner products become angles: with c the mean of all vectors and M the largest norm of a centred
one, the points (x - c, sqrt(M^2 - |x - c|^2)) and (q, 0) lie on spheres around the origin, and the best scores
of q are the smallest angles. Angles are a metric. Every vector is keyed by its nearest pivot and its
angle to it; a cell is an annulus of one pivot, and holds the least and the largest angle of its
vectors to that pivot and to some reference pivots. By the triangle inequality no vector of a cell
is nearer to q than its annulus, around any of these pivots, is to q's own angle from it. Each query
first expands the cells next to it until they hold k candidates in plenty, which bounds its k-th
angle; then some more below that bound, which tightens it; then all others whose bound is still below it.

Pivots and cells grow with the square root of the number of vectors. Cells with many vectors (or many equal
ones, which no radius tells apart) are dealt to several blocks, so that a task joins a bounded block of vectors
with a bounded chunk of queries. In many dimensions without structure all angles are nearly right ones
and the bounds leave out little or nothing: the search stays exact and visits all cells.

Defined cases: vectors that are null or hold null or non-finite components take no part, and
neither do rows with a null id; vectors of unequal lengths are padded with zeros; rows of one id
are separate: each asks for itself, and is a candidate of all rows but itself; ties go to the smaller id;
fewer candidates than k give fewer rows; scores beyond 63 bits and a sign are clipped to them; no
valid vectors give an empty result; ids must be whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faunagrid.llm.storage import stored, table

SCALE = 1024
#: Pivots for each square root of the number of vectors; annuli of one pivot at most, and vectors of one, at about.
PIVOTS = 1 / 2
RINGS = 8
ANNULUS = 512
#: Pivots to which every cell knows the angles of its vectors.
REFERENCES = 8
#: Vectors in a block, and queries in a chunk, at about.
BLOCK = 2048
CHUNK = 4096
#: Candidates for each result wanted that the cells of the first rounds hold; the last round visits all the rest within the bound.
FIRST = (20, 400)
#: Bounds of queries and cells that are held at a time.
HELD = 2_000_000
#: Largest magnitude of a product that doubles hold exactly.
EXACT = float(1 << 53)
#: Slack of angles, against rounding: cosines near 1 keep half of a double's digits.
SLACK = 1e-7


def scaled(vectors: Column, scale: int = SCALE) -> Column:
    """Whole numbers, in doubles: large ones are whole already, and beyond what Spark's floor returns."""

    def whole(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    return F.transform(vectors, whole)


def valid(vectors: Column) -> Column:
    finite = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    return out


def directions(points: np.ndarray) -> np.ndarray:
    """Points at distance 1 from the origin; the origin itself stays."""
    norms = np.sqrt((points * points).sum(1, keepdims=True))
    return points / np.where(norms > 0, norms, 1.0)


def lifted(vectors: np.ndarray, centre: np.ndarray, largest: float) -> np.ndarray:
    """The directions of centred vectors with one more component, by which all are on one sphere."""
    x = vectors - centre
    rest = np.sqrt(np.maximum(largest - (x * x).sum(1), 0.0))
    return directions(np.hstack([x, rest[:, None]]))


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def scores(queries: np.ndarray, vectors: np.ndarray, largest: float) -> np.ndarray:
    """Integer inner products; beyond the range of exact doubles by Python's integers."""
    if largest < EXACT:  # no partial sum is larger, by Cauchy and Schwarz over fewer components
        return (queries @ vectors.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], object) @ np.array([[int(x) for x in row] for row in vectors], object).T
    return np.clip(exact, 1 - (1 << 63), (1 << 63) - 1).astype(np.int64)


@dataclass
class Annuli:
    """What bounds need: pivots, and the angles that each cell spans. It travels with the tasks."""

    pivots: np.ndarray
    centre: np.ndarray
    largest: float
    cells: pd.DataFrame

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and cell an angle that none of the cell's vectors is nearer than."""
        far = angles(directions(np.hstack([queries, np.zeros((len(queries), 1))])), self.pivots)
        cells = self.cells
        own = far[:, cells["cell"].to_numpy() // RINGS]
        least = np.maximum(np.maximum(cells["inner"].to_numpy() - own, own - cells["outer"].to_numpy()), 0.0)
        for i in range(min(REFERENCES, len(self.pivots))):
            at = far[:, i : i + 1]
            np.maximum(least, np.maximum(cells[f"low{i}"].to_numpy() - at, at - cells[f"high{i}"].to_numpy()), out=least)
        return least

    def radius(self, queries: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """The angle within which all vectors score at least ``kth``; NaN scores give the half circle."""
        norms = np.sqrt((queries * queries).sum(1) * self.largest)
        with np.errstate(invalid="ignore", divide="ignore"):
            cosine = (kth - queries @ self.centre) / norms
        return np.where(np.isfinite(cosine), np.arccos(np.clip(cosine, -1.0, 1.0)), np.pi) + SLACK


class Index:
    """Pivots and cells on the driver (both of the order of the root of n), keyed vectors on shared storage."""

    def __init__(self, vectors: DataFrame) -> None:
        """``vectors``: (row, id, v) with valid ``v`` of whole numbers in doubles; ``row`` tells rows apart."""
        self.spark = vectors.sparkSession
        n, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
        self.n, self.width = n, int(width or 0)
        if not n:
            return
        means = vectors.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()  # a row a component
        self.centre = np.zeros(self.width)
        for r in means:
            self.centre[r["at"]] = r.x / n
        centre, width = self.centre, self.width
        square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
        self.norms = float(vectors.agg(F.max(square)).first()[0] or 0.0)

        def farthest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = matrix(batch["v"], width) - centre
                yield pd.DataFrame({"square": [float((x * x).sum(1).max(initial=0.0))]})

        self.largest = float(vectors.select("v").mapInPandas(farthest, "square double").agg(F.max("square")).first()[0])
        sample = vectors.orderBy(F.xxhash64("id", "row"), "row").limit(math.ceil(PIVOTS * math.sqrt(n))).toPandas()
        self.pivots = lifted(matrix(sample["v"], width), centre, self.largest)
        pivots, largest, references = self.pivots, self.largest, min(REFERENCES, len(sample))

        def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                far = angles(lifted(matrix(batch["v"], width), centre, largest), pivots)
                near = far.argmin(1)
                yield batch.assign(pivot=near.astype(np.int32), radius=far[np.arange(len(batch)), near], far=[*far[:, :references]])

        keyed = stored(vectors.mapInPandas(key, "row long, id long, v array<double>, pivot int, radius double, far array<double>"), "keyed")
        span = keyed.groupBy("pivot").agg(F.min("radius").alias("inner"), F.max("radius").alias("outer"), F.count("*").alias("n"))
        span = span.withColumn("rings", F.least(F.lit(RINGS), F.ceil(F.col("n") / ANNULUS)).cast("int")).select("pivot", "inner", "rings", ((F.col("outer") - F.col("inner")) / F.col("rings")).alias("step"))
        ring = F.when(F.col("step") > 0, F.least(F.floor((F.col("radius") - F.col("inner")) / F.col("step")), F.col("rings") - 1)).otherwise(0).cast("int")
        keyed = keyed.join(F.broadcast(span), "pivot").withColumn("cell", F.col("pivot") * RINGS + ring).drop("inner", "rings", "step")
        ranges = [f(F.col("far")[i]).alias(f"{name}{i}") for i in range(references) for name, f in (("low", F.min), ("high", F.max))]
        cells = keyed.groupBy("cell").agg(F.min("radius").alias("inner"), F.max("radius").alias("outer"), F.count("*").alias("n"), *ranges)
        self.cells = cells.orderBy("cell").toPandas()
        self.cells["blocks"] = -(-self.cells["n"] // BLOCK)
        self.blocks = self.spark.createDataFrame(self.cells[["cell", "blocks"]].astype("int32"), "cell int, blocks int")
        self.keyed = keyed.select("row", "id", "v", "cell").join(F.broadcast(self.blocks), "cell").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).drop("blocks")

    def visits(self, queries: DataFrame, low: float, high: float) -> DataFrame:
        """Of queries (row, v, chunk, kth; null before the first round): a row for each cell that each visits now.

        Cells are taken in the order of their bounds, those after ``low`` candidates and before ``high`` of them.
        """
        of, sizes = (self.cells[x].to_numpy() for x in ("cell", "n"))
        annuli, width = Annuli(self.pivots, self.centre, self.largest, self.cells), self.width

        def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            step = max(1, HELD // len(of))
            for whole in batches:
                for start in range(0, len(whole), step):
                    batch = whole.iloc[start : start + step]
                    v = matrix(batch["v"], width)
                    least = annuli.bounds(v)
                    order = np.argsort(least, axis=1, kind="stable")
                    before = np.cumsum(sizes[order], axis=1) - sizes[order]
                    chosen = np.zeros(order.shape, bool)
                    np.put_along_axis(chosen, order, (before >= low) & (before < high), 1)
                    chosen &= least <= annuli.radius(v, batch["kth"].to_numpy(np.float64))[:, None]
                    asking, cell = np.nonzero(chosen)
                    yield batch[["row", "v", "chunk"]].iloc[asking].assign(cell=of[cell])

        return stored(queries.mapInPandas(expand, "row long, v array<double>, chunk int, cell int"), "visits")

    def share(self, visits: DataFrame, queries: int) -> float:
        """The share of all pairs of queries and vectors that visits look at."""
        return (visits.join(self.spark.createDataFrame(self.cells[["cell", "n"]].astype("int64")), "cell").agg(F.sum("n")).first()[0] or 0) / (queries * self.n)

    def join(self, visits: DataFrame, k: int) -> DataFrame:
        """The k best of each block for each query that visits it."""
        width, largest = self.width, self.norms
        asked = visits.join(F.broadcast(self.blocks), "cell").select("row", "v", "chunk", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        wanted = visits.select(F.col("cell").alias("in_cell"), F.col("chunk").alias("by_chunk")).distinct()
        held = self.keyed.join(wanted, F.col("cell") == F.col("in_cell")).select("row", "id", "v", F.col("in_cell").alias("cell"), F.col("block"), F.col("by_chunk").alias("chunk"))

        def best(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            out = {"query": [], "vec_id": [], "score": []}
            if len(q) and len(x):
                x = x.sort_values("id")
                ids, rows, vectors = x["id"].to_numpy(), x["row"].to_numpy(), matrix(x["v"], width)
                for start in range(0, len(q), 256):
                    part = q.iloc[start : start + 256]
                    for own, row in zip(part["row"].to_numpy(), scores(matrix(part["v"], width), vectors, largest), strict=True):
                        if len(row) > k + 1:
                            at = np.flatnonzero(row >= np.partition(row, -k - 1)[-k - 1])
                        else:
                            at = np.arange(len(row))
                        at = at[np.argsort(-row[at], kind="stable")]  # ids ascend, so ties go to the smaller
                        at = at[rows[at] != own][:k]
                        out["query"].append(np.full(len(at), own))
                        out["vec_id"].append(ids[at])
                        out["score"].append(row[at])
            return pd.DataFrame({c: np.concatenate(x) if x else np.empty(0, np.int64) for c, x in out.items()})

        by = ["cell", "block", "chunk"]
        return asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(best, "query long, vec_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """Per query the k best: (query, best: array of (minus, vec_id), in order)."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id")))
    return found.groupBy("query").agg(F.slice(ordered, 1, k).alias("best"))


def search(df: DataFrame, queries: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row of ``df`` that ``queries`` selects, its k best other rows: query_id, rank, vec_id, score."""
    return searched(df, queries, k, key, vector)[0]


def searched(df: DataFrame, queries: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, float]:
    """``search``, and the share of all pairs that it looked at."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("raw"), queries.alias("asks")).where(F.col("id").isNotNull() & valid(F.col("raw")))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", scaled(F.col("raw")).alias("v"), "asks"), "vectors")
    index = Index(rows.select("row", "id", "v"))
    asking = rows.where("asks")
    n = asking.count() if index.n else 0
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long"), 0.0
    chunks = -(-n // CHUNK)
    asking = asking.select("row", "id", "v", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"))
    asked = asking.select("row", "v", "chunk")
    kth = F.when(F.size("best") == k, -F.element_at("best", -1)["minus"]).cast("double")
    held, share, low = None, 0.0, 0.0
    for high in (*(x * k for x in FIRST), math.inf):
        if held is None:
            bounded = asked.withColumn("kth", F.lit(None).cast("double"))
        else:
            bounded = asked.join(held.select(F.col("query").alias("row"), kth.alias("kth")), "row", "left")
        now = index.visits(bounded, low, high)
        share += index.share(now, n)
        found = best_of(index.join(now, k), k)
        if held is not None:
            found = held.unionByName(found).groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        held, low = stored(found, "nearest"), high
    ranked = held.join(asking.select(F.col("row").alias("query"), F.col("id").alias("query_id")), "query").select("query_id", F.posexplode("best").alias("at", "x"))
    found = ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score"))
    return found, share


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP8_SQL = """
WITH v AS (
    SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
