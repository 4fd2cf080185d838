"""Derived datasets: counted duplicates, regions, decades, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunagrid.sources.occurrences import within

# Boxes as lon_min, lat_min, lon_max, lat_max. The second is kept as published, with
# longitude and latitude exchanged: it is no part of Florida.
SOUTH_ATLANTIC = (-69.6008, -60.0, 20.0091, 0.0751)
FLORIDA_KEYS_AS_PUBLISHED = (20.0, -90.0, 30.0, -70.0)
#: Both years belong to a decade, so that one year is in two of them.
DECADES = {f"{first}s": (first, first + 10) for first in range(1960, 2020, 10)}
SAMPLE = 1_000_000
SEED = 42
#: Logarithm of the number of hash ranges by which a sample is cut.
RANGES = 12


def count_duplicates(df: DataFrame) -> DataFrame:
    """``records``: how many rows there are of each place, species and year; species must be known."""
    keys = ["decimalLongitude", "decimalLatitude", "species", "date_year"]
    return df.where("species IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("records"))


def between_years(df: DataFrame, first: int, last: int) -> DataFrame:
    return df.where(F.col("date_year").between(int(first), int(last)))


def sample_exactly(df: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """n rows (all, if fewer) without replacement: those first in a seeded hash order, so that reruns agree.

    Rows are counted by ranges of the hash; those of whole ranges are taken as they stand, and only one range is sorted.
    """
    if n < 0:
        raise ValueError("a sample cannot be negative")
    order = F.xxhash64(F.lit(seed), *df.columns)
    part = F.shiftright(order, 64 - RANGES)
    counts = sorted(df.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # 2^RANGES rows at most
    before = 0
    for r in counts:
        if before + r.n > n:
            last = df.where(part == r.part).orderBy(order, *df.columns).limit(n - before)
            return df.where(part < r.part).unionByName(last)
        before += r.n
    return df


def occurrence_sample(df: DataFrame, n: int = SAMPLE) -> DataFrame:
    return sample_exactly(count_duplicates(df), n)


def south_atlantic(df: DataFrame) -> DataFrame:
    return within(count_duplicates(df), SOUTH_ATLANTIC)


def florida_keys_as_published(df: DataFrame) -> DataFrame:
    return within(count_duplicates(df), FLORIDA_KEYS_AS_PUBLISHED)


def write_datasets(df: DataFrame, root: str, n: int = SAMPLE) -> dict[str, str]:
    """Writes all named datasets of a normalised source below ``root``, over older ones; returns their folders.

    Duplicates are counted once, into ``root``/occ, from which the others are drawn.
    """
    spark = df.sparkSession
    paths = {"occ": f"{root.rstrip('/')}/occ"}
    count_duplicates(df).write.mode("overwrite").parquet(paths["occ"])
    whole = spark.read.parquet(paths["occ"])
    made = {"occ_1M": sample_exactly(whole, n), "occ_SAtlantic": within(whole, SOUTH_ATLANTIC), "occ_fk": within(whole, FLORIDA_KEYS_AS_PUBLISHED)}
    made |= {f"occ_{name}": sample_exactly(between_years(whole, *years), n) for name, years in DECADES.items()}
    for name, rows in made.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        rows.write.mode("overwrite").parquet(paths[name])
    return paths


def decade(df: DataFrame, name: str, n: int = SAMPLE) -> DataFrame:
    return sample_exactly(between_years(count_duplicates(df), *DECADES[name]), n)
