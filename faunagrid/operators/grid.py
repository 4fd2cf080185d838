"""Grids of cells: generation, joins with indicators, and what a map needs of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faunagrid.functions.cells import cell_to_string
from faunagrid.functions.h3core import all_cells, cell_boundary_wkt, cell_corners
from faunagrid.functions.projection import robinson

#: Legend transformations by name.
TRANSFORMS = {
    "identity": lambda x: x,
    "log10": F.log10,
    "log2": F.log2,
    "log": F.log,
    "log1p": F.log1p,
    "sqrt": F.sqrt,
    "exp": F.exp,
    "reciprocal": lambda x: F.try_divide(F.lit(1.0), x),
    "reverse": lambda x: -x,
}


def make_grid(spark: SparkSession, res: int = 2) -> DataFrame:
    """(hexid, cell_id, geometry): all cells of a resolution, with boundaries in WKT."""

    cells = all_cells(spark, res)
    return cells.select(cell_to_string("cell_id").alias("hexid"), "cell_id", cell_boundary_wkt(F.col("cell_id")).alias("geometry"))


def join_grid(grid: DataFrame, indicators: DataFrame, cell: str = "cell") -> DataFrame:
    """Grid cells that have indicators; Spark broadcasts a side only if its size is below its limit."""
    return grid.join(indicators, grid["hexid"] == indicators[cell], "inner")


def map_layer(grid: DataFrame, column: str = "shannon", label: str = "Shannon index", trans: str = "identity") -> DataFrame:
    """(hexid, geometry, fill, label): the transformed indicator that fills each cell; NULL stays NULL."""
    if trans not in TRANSFORMS:
        raise ValueError(f"unknown transformation: {trans}")
    if column not in grid.columns:
        raise ValueError(f"no such column: {column}")
    fill: Column = TRANSFORMS[trans](F.col(column).cast("double"))
    return grid.select("hexid", "geometry", fill.alias("fill"), F.lit(label).alias("label"))


def projected_extent(cells: DataFrame, cell: str = "cell_id") -> DataFrame:
    """The bounding box, in metres, of the corners of cells on a Robinson map."""
    corners = cells.select(F.explode(cell_corners(F.col(cell))).alias("c"))
    x, y = robinson(F.col("c.lng"), F.col("c.lat"))
    return extent(corners.select(x.alias("x"), y.alias("y")), "x", "y")


def extent(points: DataFrame, lng: str = "lng", lat: str = "lat") -> DataFrame:
    """The bounding box of points."""
    return points.agg(F.min(lng).alias("xmin"), F.min(lat).alias("ymin"), F.max(lng).alias("xmax"), F.max(lat).alias("ymax"))
