"""Diversity indicators of grid cells.

Two shuffles: records are summed by cell and species with map-side combination, then dealt by
cell. The second holds one row per species of a cell, however many records there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunagrid.functions.stats import entropy_term, es_term
from faunagrid.schema import ESN

COLUMNS = ("n", "sp", "shannon", "simpson", "maxp", "es", "hill_1", "hill_2", "hill_inf")


def _checked(df: DataFrame, esn: float) -> None:
    if not isinstance(df, DataFrame):
        raise TypeError("occurrences must be a DataFrame")
    if isinstance(esn, bool) or not isinstance(esn, int | float) or not 0 <= esn < float("inf"):
        raise ValueError(f"the sample size must be a number of at least 0, not {esn!r}")


def _have(df: DataFrame, *needed: str) -> None:
    if missing := {*needed} - {*df.columns}:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")


def species_totals(df: DataFrame, *keys: str) -> DataFrame:
    """``ni``, the records of each species of each cell. NULL species are a species; NULL records count nothing."""
    return df.groupBy(*keys, "species").agg(F.coalesce(F.sum("records"), F.lit(0)).alias("ni"))


def indicators_of(totals: DataFrame, *keys: str, esn: float = ESN) -> DataFrame:
    """All indicators from (keys, species, ni), one row per species and cell.

    Simpson's index is the sum of squared records over n squared. A sum of squared shares would depend in its last bits
    on the order of species, and so would the side of a tie that it is rounded to.
    """
    exact = "decimal(19,0)" if isinstance(totals.schema["ni"].dataType, T.IntegralType) else "double"  # squares of 64-bit counts, and their sums, have 38 digits
    squared = {c: F.col(c).cast(exact) * F.col(c).cast(exact) for c in ("ni", "n")}
    totals = totals.withColumn("n", F.sum("ni").over(Window.partitionBy(*keys)))
    p = F.try_divide(F.col("ni").cast("double"), F.col("n").cast("double"))
    terms = totals.select(*keys, "n", entropy_term(p).alias("hi"), squared["ni"].alias("si"), p.alias("qi"), es_term(F.col("n"), F.col("ni"), esn).alias("esi"))
    found = terms.groupBy(*keys).agg(F.max("n").alias("n"), F.count("*").alias("sp"), (F.sum("hi") + 0.0).alias("shannon"), F.sum("si").cast("double").alias("squares"), F.max("qi").alias("maxp"), F.sum("esi").alias("es"))
    whole = squared["n"].cast("double")
    found = found.withColumns({"simpson": F.try_divide(F.col("squares"), whole), "hill_1": F.exp("shannon"), "hill_2": F.try_divide(whole, F.col("squares")), "hill_inf": F.try_divide(F.lit(1.0), F.col("maxp"))})
    return found.select(*keys, *COLUMNS)


def calc_indicators(df: DataFrame, esn: float = ESN) -> DataFrame:
    """Indicators of every ``cell`` of occurrences (cell, species, records).

    n: records; sp: species; shannon; simpson: sum of squared shares; maxp: largest share; es:
    expected species among ``esn`` records, NULL where there are fewer; hill_1, hill_2, hill_inf.
    A cell without records has n 0 and no shares.
    """
    _checked(df, esn)
    _have(df, "cell", "species", "records")
    return indicators_of(species_totals(df, "cell"), "cell", esn=esn)


def summary(df: DataFrame, column: str = "value") -> DataFrame:
    """Least and largest value, quantiles of 2 and 98 percent (interpolated), and how many there are: one row."""
    values = df.select(F.col(column).cast("double").alias("value")).where("value IS NOT NULL").persist()
    try:
        least, most, n = values.agg(F.min("value"), F.max("value"), F.count("*")).first()
        found = [least, most, *(quantile(values, share, n) if n else None for share in (0.02, 0.98)), n]
    finally:
        values.unpersist()
    return df.sparkSession.createDataFrame([found], "min double, max double, p02 double, p98 double, n long")


def quantile(values: DataFrame, share: float, n: int, error: float = 1e-3) -> float:
    """The interpolated quantile of n values, exactly; only values between two approximate quantiles around it are sorted."""
    place = share * (n - 1)
    wanted = int(place)
    low, high = values.approxQuantile("value", [max(0.0, share - 2 * error), min(1.0, share + 2 * error)], error)
    below, upto = values.agg(F.count_if(F.col("value") < low), F.count_if(F.col("value") <= high)).first()
    if below > wanted or upto < min(n, wanted + 2):  # of few values the approximate ones may lie on one side
        below, near = 0, values
    else:
        near = values.where(F.col("value").between(low, high))
    near = near.orderBy("value").offset(wanted - below).limit(2).collect()
    first, second = near[0].value, near[-1].value
    return first + (second - first) * (place - wanted)
