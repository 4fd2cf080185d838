"""Occurrence sources: flat or nested tables, brought to one shape and cleaned."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunagrid.schema import FLAGS, NESTED, OPTIONAL, REQUIRED


def read(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files, folders or patterns as one table; the schema is that of one footer."""
    return spark.read.option("mergeSchema", "false").parquet(*paths)


def local_or_remote(local: str, remote: str, use_remote: bool = False) -> list[str]:
    """The local folder's files if it has any, else the remote pattern if that is wanted, else nothing."""
    found = sorted(map(str, Path(local).glob("**/*.parquet"))) if Path(local).is_dir() else []
    return found or ([remote] if use_remote else [])


class Fields:
    """The columns of a source by name in any letter case, whether flat or in a struct."""

    def __init__(self, df: DataFrame) -> None:
        self.top = {f.name.lower(): f for f in df.schema.fields}
        nested = self.top.get(NESTED)
        self.nested = nested is not None and isinstance(nested.dataType, T.StructType)
        self.inner = {f.name.lower(): f.name for f in nested.dataType.fields} if self.nested else {}

    def find(self, name: str) -> Column | None:
        """A record's own field: of the struct if there is one."""
        if self.nested:
            own = self.inner.get(name.lower())
            return F.col(f"`{NESTED}`.`{own}`") if own else None
        return self.flag(name)

    def flag(self, name: str) -> Column | None:
        """A field beside the struct."""
        own = self.top.get(name.lower())
        return F.col(f"`{own.name}`") if own else None


def normalise(df: DataFrame) -> DataFrame:
    """decimalLongitude, decimalLatitude, species, the optional columns (typed NULLs for missing ones),
    ``records`` (NULL column left out if there is none) and the flags that the source has."""
    fields = Fields(df)
    out = []
    for name, kind in zip(REQUIRED, ("double", "double", "string"), strict=True):
        found = fields.find(name)
        if found is None:
            raise ValueError(f"the source lacks {name}")
        out.append(found.cast(kind).alias(name))
    for name, kind in OPTIONAL.items():
        found = fields.find(name)
        out.append((F.lit(None) if found is None else found).cast(kind).alias(name))
    records = fields.find("records")
    if records is not None:
        out.append(F.bround(records).cast("bigint").alias("records"))
    out += [flag.cast("boolean").alias(name) for name in FLAGS if (flag := fields.flag(name)) is not None]
    if (cell := fields.find("cell_id")) is not None:
        out.append(cell.cast("bigint").alias("cell_id"))
    return df.select(*out)


def within(df: DataFrame, box: Sequence[float]) -> DataFrame:
    """Records in (lon_min, lat_min, lon_max, lat_max), bounds included; a box does not cross the date line."""
    if len(box) != 4:
        raise ValueError("a box has four numbers: lon_min, lat_min, lon_max, lat_max")
    lon_min, lat_min, lon_max, lat_max = map(float, box)
    return df.where(F.col("decimalLongitude").between(lon_min, lon_max) & F.col("decimalLatitude").between(lat_min, lat_max))


def known(df: DataFrame) -> DataFrame:
    """Records with a species and a place, by tests that reach the scan."""
    for name in REQUIRED:
        df = df.where(F.col(name).isNotNull())
    return df


def present(df: DataFrame) -> DataFrame:
    """Records whose flags (those that the source has) are false or NULL."""
    for name in FLAGS:
        if name in df.columns:
            df = df.where(~F.col(name).eqNullSafe(True))
    return df


def cleaned(df: DataFrame, box: Sequence[float] | None = None) -> DataFrame:
    """A normalised source without records that are unknown, dropped, absent or outside the box."""
    df = present(known(df))
    return df if box is None else within(df, box)
