"""Schemas, ranks and resolutions of occurrences and stores."""

from __future__ import annotations

from pyspark.sql import types as T

# Taxonomic ranks, resolutions of the species store, and of the index.
RANKS = ("phylum", "class", "order", "family", "genus", "species")
TIERS = (3, 5, 7)
BASE_RES = 7
INDEX_RES = tuple(range(1, 8))
INDICATORS = ("es", "sp", "shannon", "n")
ESN = 50

#: Optional columns of a flat source, with the type of the NULL that stands for a missing one.
OPTIONAL = {
    "aphiaid": "bigint",
    "phylum": "string",
    "class": "string",
    "order": "string",
    "family": "string",
    "genus": "string",
    "date_year": "smallint",
}
REQUIRED = ("decimalLongitude", "decimalLatitude", "species")
FLAGS = ("dropped", "absence")
NESTED = "interpreted"

OCC = T.StructType(
    [
        T.StructField("res", T.ByteType()),
        T.StructField("cell_id", T.LongType()),
        *(T.StructField(c, t) for c, t in (("aphiaid", T.LongType()), *((r, T.StringType()) for r in RANKS), ("date_year", T.ShortType()))),
        T.StructField("records", T.LongType()),
    ]
)
IDX = T.StructType(
    [
        T.StructField("res", T.ByteType()),
        T.StructField("cell_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("sp", T.LongType()),
        *(T.StructField(c, T.DoubleType()) for c in ("shannon", "simpson", "es")),
    ]
)
