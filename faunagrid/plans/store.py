"""The two-layer store: species records at three resolutions, and indicators at seven.

One pass bins and counts the source at the finest resolution. That base is written once and read
for both layers; each coarser layer is rolled up from the one below it, so that no layer
shuffles more rows than its finer one holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faunagrid.functions.cells import cell_to_parent
from faunagrid.functions.h3core import latlng_to_cell
from faunagrid.operators.indicators import indicators_of
from faunagrid.schema import BASE_RES, ESN, IDX, INDEX_RES, OCC, RANKS, TIERS
from faunagrid.sources.occurrences import cleaned, normalise, read

KEYS = ["cell_id", "aphiaid", *RANKS, "date_year"]
#: (longitude, latitude, resolution) to a cell id.
CellFunction = Callable[[Column, Column, int], Column]


def cells_of(df: DataFrame, cell_fn: CellFunction | None = None, res: int = BASE_RES) -> DataFrame:
    """``df`` with ``cell_id``: by ``cell_fn``, or as the source has it. Places without a cell are dropped."""
    if cell_fn is not None:
        df = df.withColumn("cell_id", cell_fn(F.col("decimalLongitude"), F.col("decimalLatitude"), res))
    elif "cell_id" not in df.columns:
        df = df.withColumn("cell_id", latlng_to_cell(F.col("decimalLatitude"), F.col("decimalLongitude"), res))
    return df.where("cell_id IS NOT NULL")


def base_records(source: DataFrame, box: Sequence[float] | None = None, cell_fn: CellFunction | None = None) -> DataFrame:
    """Records by finest cell, taxon and year: summed where the source counts them, else one a row."""
    clean = cells_of(cleaned(normalise(source), box), cell_fn)
    records = F.sum("records") if "records" in clean.columns else F.count("*")
    return clean.groupBy(*KEYS).agg(records.alias("records"))


def _rolled(df: DataFrame, res: int, *keys: str, value: str) -> DataFrame:
    others = [k for k in keys if k != "cell_id"]
    return df.groupBy(cell_to_parent("cell_id", res).alias("cell_id"), *others).agg(F.sum(value).alias(value))


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields))


def occ_tiers(base: DataFrame) -> DataFrame:
    """The species store: the base, and its roll-ups, each from the tier below."""
    out, current = None, base
    for res in sorted(TIERS, reverse=True):
        if res != BASE_RES:
            current = _rolled(current, res, *KEYS, value="records")
        tier = _typed(current.withColumn("res", F.lit(res)), OCC)
        out = tier if out is None else out.unionByName(tier)
    return out


def index_of(base: DataFrame, esn: float = ESN, levels: Sequence[int] = INDEX_RES) -> DataFrame:
    """The indicator store: species totals of each resolution from the next finer one, then one pass over all."""
    totals = base.groupBy("cell_id", "species").agg(F.sum("records").alias("ni"))
    out, current = None, totals
    for res in sorted(levels, reverse=True):
        if res != BASE_RES:
            current = _rolled(current, res, "cell_id", "species", value="ni")
        level = current.withColumn("res", F.lit(res))
        out = level if out is None else out.unionByName(level)
    return _typed(indicators_of(out, "res", "cell_id", esn=esn), IDX)


class Store:
    """A written store: ``occ_h3`` and ``idx_h3``, each a Parquet folder by resolution."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def occ(self) -> DataFrame:
        return self.spark.read.schema(OCC).parquet(f"{self.path}/occ_h3").select(*OCC.names)

    def idx(self) -> DataFrame:
        return self.spark.read.schema(IDX).parquet(f"{self.path}/idx_h3").select(*IDX.names)


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def build_store(
    spark: SparkSession,
    src: DataFrame | str | Sequence[str],
    path: str,
    region_bbox: Sequence[float] | None = None,
    esn: float = ESN,
    cell_fn: CellFunction | None = None,
    overwrite: bool = True,
) -> str:
    """Builds a store at ``path`` from a DataFrame, or from Parquet paths; returns the path.

    It is written beside the path and moved there when complete; the old store is moved aside
    before and deleted after, so that a failed build leaves it as it was.
    """
    fs, target = _files(spark, path)
    if fs.exists(target) and not overwrite:
        raise FileExistsError(f"{path} exists; pass overwrite=True to replace it")
    source = src if isinstance(src, DataFrame) else read(spark, *([src] if isinstance(src, str) else src))
    staging = f"{path.rstrip('/')}.building-{uuid.uuid4().hex}"
    try:
        base_records(source, region_bbox, cell_fn).write.parquet(f"{staging}/base")
        base = spark.read.parquet(f"{staging}/base")
        occ_tiers(base).write.partitionBy("res").parquet(f"{staging}/occ_h3")
        index_of(base, esn).write.partitionBy("res").parquet(f"{staging}/idx_h3")
        fs.delete(_files(spark, f"{staging}/base")[1], True)
        fs.mkdirs(target.getParent())
        aside = _files(spark, f"{staging}-old")[1]
        if fs.exists(target) and not fs.rename(target, aside):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(_files(spark, staging)[1], target):
            if fs.exists(aside):
                fs.rename(aside, target)
            raise OSError(f"cannot move {staging} to {path}")
        fs.delete(aside, True)
    finally:
        fs.delete(_files(spark, staging)[1], True)
    return path


def publish(spark: SparkSession, root: str, version: str) -> str:
    """Points ``root``/CURRENT, a file, at a version's folder, by one rename over the old file; returns the folder."""
    root = root.rstrip("/")
    fs, folder = _files(spark, f"{root}/{version}")
    if not fs.exists(folder):
        raise FileNotFoundError(f"no version {version} in {root}")
    jvm = spark.sparkContext._jvm
    fresh, current = (_files(spark, f"{root}/{name}")[1] for name in (f".CURRENT-{uuid.uuid4().hex}", "CURRENT"))
    out = fs.create(fresh, False)
    out.write(bytearray(version.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri() if folder.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(fresh), fs.makeQualified(current), over)
    return f"{root}/{version}"


def published(spark: SparkSession, root: str) -> Store:
    root = root.rstrip("/")
    return Store(spark, f"{root}/{spark.read.text(f'{root}/CURRENT').first().value}")


def dated(spark: SparkSession, src: DataFrame | str | Sequence[str], root: str, day: date | None = None, **options) -> str:
    """Builds the version of a day below ``root`` and publishes it; returns its folder."""
    version = f"v{day or date.today():%Y-%m-%d}"
    build_store(spark, src, f"{root.rstrip('/')}/{version}", **options)
    return publish(spark, root, version)
