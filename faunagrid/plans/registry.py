"""The registered queries of the indicator engine and the SQL they are checked against.

The driver's tables hold no occurrences, so these are derived: ``events`` as records of event types
in the cells of users, and ``lineitem`` with ``part`` as full occurrences, with places, taxa,
years, flags and ids in the bit layout of a hexagonal grid. Both engines read the same text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faunagrid.functions.cells import cell_to_parent, cell_to_string, resolution, string_to_cell
from faunagrid.functions.h3core import all_cells, cell_to_latlng, latlng_to_cell
from faunagrid.functions.projection import DISTANCE, FACTORS, LENGTH, RADIUS, robinson
from faunagrid.functions.stats import es_term, lgamma
from faunagrid.operators import datasets, grid, indicators
from faunagrid.plans import store as stores
from faunagrid.plans import tiles
from faunagrid.schema import INDEX_RES, INDICATORS, RANKS, TIERS
from faunagrid.scratch import new_path
from faunagrid.sources import occurrences

Query = Callable[[SparkSession, str], DataFrame]

_STEP = "CAST(4503599627370496 AS BIGINT)"  # 2^52, one resolution

#: Occurrences from lineitem and part; the cell is a made-up one of resolution 7.
OCCURRENCES = f"""
SELECT CAST((l_suppkey * 37 + l_partkey * 11) % 360 - 180 AS DOUBLE) AS decimalLongitude,
 CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST((l_suppkey * 53 + l_partkey * 7) % 180 - 90 AS DOUBLE) END AS decimalLatitude,
 CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE p_name END AS species,
 l_partkey AS AphiaID, p_type AS phylum, p_brand AS class, CAST(year(l_shipdate) AS SMALLINT) AS date_year,
 CAST(l_quantity AS BIGINT) AS records,
 CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS dropped,
 CASE WHEN l_linenumber = 7 THEN TRUE WHEN l_linenumber = 6 THEN FALSE END AS absence,
 576460752303423488 + 7 * {_STEP} + (l_suppkey % 5) * 35184372088832
 + {" + ".join(f"CAST(FLOOR(l_suppkey / CAST({7**k} AS DOUBLE)) % 7 AS BIGINT) * {1 << 24 + 3 * k}" for k in range(6))} + 16777215 AS cell_id
FROM lineitem JOIN part ON l_partkey = p_partkey"""
#: The same, with years that go back to the sixties.
EARLIER = OCCURRENCES.replace("CAST(year(l_shipdate) AS SMALLINT)", "CAST(year(l_shipdate) + 16 - 12 * (l_partkey % 5) AS SMALLINT)")
EVENTS = "SELECT user_id AS cell, event_type AS species, 1 AS records FROM events"

_VALID = "species IS NOT NULL AND decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL"
_KEPT = f"{_VALID} AND dropped IS NOT TRUE AND absence IS NOT TRUE"
BOX = (-60.0, -45.0, 90.0, 45.0)


# --- sources, as DataFrames ---


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """SQL over the driver's tables, named as they are."""
    for name in ("lineitem", "part", "events"):
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    used = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("lineitem", "part", "events") if f"{{{name}}}" in text}
    return spark.sql(text, **used)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, EVENTS)


def _occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, OCCURRENCES)


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences.normalise(_occurrences(spark, sf_dir))


def _earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences.normalise(_sql(spark, sf_dir, EARLIER))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.base_records(_occurrences(spark, sf_dir))


class _InMemory:
    """A store that is a plan: its layers are computed from the driver's tables as a query reads them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.base = spark, _base(spark, sf_dir)

    def occ(self) -> DataFrame:
        return stores.occ_tiers(self.base)

    def idx(self) -> DataFrame:
        return stores.index_of(self.base)


# --- results: doubles to six places, -0.0 as 0.0 ---


def _even(df: DataFrame) -> DataFrame:
    return df.select(*((F.round(F.col(f"`{c}`"), 6) + 0.0).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes))


def _round(text: str) -> str:
    return f"(round({text}, 6) + 0.0)"


def _parent_sql(cell: str, res: int) -> str:
    return f"(((({cell}) & ~(15 * {_STEP})) | ({res} * {_STEP})) | (CAST({1 << 3 * (15 - res)} AS BIGINT) - 1))"


_MEASURES = {
    "n": "CAST(max(n) AS BIGINT)",
    "sp": "count(*)",
    "shannon": _round("sum(-p * ln(p))"),
    "simpson": _round("sum(p * p)"),
    "maxp": _round("max(p)"),
    "es": _round("sum(esi)"),
    "hill_1": _round("exp(sum(-p * ln(p)))"),
    "hill_2": _round("1 / sum(p * p)"),
    "hill_inf": _round("1 / max(p)"),
}


def _indicator_sql(totals: str, key: str, what: list[str], esn: float = 50) -> str:
    """Indicators in SQL, in the form with a join on the totals and ln gamma."""
    m = esn
    return f"""
WITH t AS ({totals}), tot AS (SELECT {key}, sum(ni) AS n FROM t GROUP BY {key}),
per AS (
    SELECT {key}, CAST(ni AS DOUBLE) / n AS p, n,
      CASE WHEN n - ni >= {m} THEN 1 - exp(lgamma(CAST(n - ni + 1 AS DOUBLE)) + lgamma(CAST(n - {m} + 1 AS DOUBLE)) - lgamma(CAST(n - ni - {m} + 1 AS DOUBLE)) - lgamma(CAST(n + 1 AS DOUBLE)))
           WHEN n >= {m} THEN 1 ELSE NULL END AS esi
    FROM t JOIN tot USING ({key})
)
SELECT {key}, {", ".join(f"{_MEASURES[w]} AS {w}" for w in what)} FROM per GROUP BY {key}"""


_ALL = list(indicators.COLUMNS)
_EVENT_TOTALS = f"SELECT cell, species, sum(records) AS ni FROM ({EVENTS}) GROUP BY 1, 2"
_LINE_TOTALS = "SELECT l_suppkey AS cell, p_type AS species, CAST(sum(l_quantity) AS BIGINT) AS ni FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"
_FEW_TOTALS = "SELECT l_partkey AS cell, l_suppkey AS species, count(*) AS ni FROM lineitem GROUP BY 1, 2"


def _by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "SELECT l_suppkey AS cell, p_type AS species, CAST(l_quantity AS BIGINT) AS records FROM lineitem JOIN part ON l_partkey = p_partkey")


def _few(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "SELECT l_partkey AS cell, l_suppkey AS species, 1 AS records FROM lineitem")


def _calc(source: Query, what: list[str], esn: float = 50) -> Query:
    return lambda spark, sf_dir: _even(indicators.calc_indicators(source(spark, sf_dir), esn).select("cell", *what))


_BASE_SQL = f"SELECT cell_id, AphiaID AS aphiaid, phylum, class, species, date_year, CAST(sum(records) AS BIGINT) AS records FROM ({OCCURRENCES}) WHERE {_KEPT} GROUP BY ALL"


def _tier_sql(res: int) -> str:
    return f"SELECT {res} AS res, {_parent_sql('cell_id', res)} AS cell_id, aphiaid, phylum, class, species, date_year, CAST(sum(records) AS BIGINT) AS records FROM base GROUP BY ALL"


def _level_sql(res: int, where: str = "TRUE") -> str:
    return f"SELECT {_parent_sql('cell_id', res)} AS cell_id, species, sum(records) AS ni FROM ({_BASE_SQL}) WHERE {where} GROUP BY 1, 2"


def _tile_sql(res: int, indicator: str, where: str = "TRUE", esn: float = 50) -> str:
    value = "CAST(" + {"n": _MEASURES["n"], "sp": _MEASURES["sp"]}.get(indicator, _MEASURES[indicator]) + " AS DOUBLE)"
    return f"SELECT cell_id, CAST({indicator}_ AS DOUBLE) AS value, n FROM ({_indicator_sql(_level_sql(res, where), 'cell_id', ['n'], esn).replace('SELECT cell_id, CAST(max', f'SELECT cell_id, {value} AS {indicator}_, CAST(max')})"


def _index_sql() -> str:
    levels = " UNION ALL ".join(f"SELECT {r} AS res, {_parent_sql('cell_id', r)} AS cell_id, species, sum(records) AS ni FROM base GROUP BY 1, 2, 3" for r in INDEX_RES)
    inner = _indicator_sql(f"SELECT *, res * 1000000000000000000 AS _k FROM levels", "res, cell_id", ["n", "sp", "shannon", "simpson", "es"])
    return f"WITH base AS ({_BASE_SQL}), levels AS ({levels}) SELECT CAST(res AS INTEGER) AS res, * EXCLUDE (res) FROM ({inner})"


def _tile(indicator: str, res: int, **request) -> Query:
    return lambda spark, sf_dir: _even(tiles.tile_query(_InMemory(spark, sf_dir), tiles.TileRequest(indicator, **request), res))


def _tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.occ_tiers(_base(spark, sf_dir)).select(F.col("res").cast("int").alias("res"), "cell_id", "aphiaid", "phylum", "class", "species", "date_year", "records")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stores.index_of(_base(spark, sf_dir))
    return _even(found.withColumn("res", F.col("res").cast("int")))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _occurrences(spark, sf_dir)
    inner = [c for c in flat.columns if c not in ("dropped", "absence")]
    wrapped = flat.select(F.struct(*inner).alias("interpreted"), "dropped", "absence")
    return stores.base_records(wrapped).select("cell_id", "aphiaid", "phylum", "class", "species", "date_year", "records")


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's own counts against one a row."""
    source = _occurrences(spark, sf_dir)
    keys = ["cell_id", "species"]
    own = stores.base_records(source).groupBy(*keys).agg(F.sum("records").alias("summed"))
    rows = stores.base_records(source.drop("records")).groupBy(*keys).agg(F.sum("records").alias("counted"))
    return own.join(rows, keys)


def _parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _occurrences(spark, sf_dir).select("cell_id").distinct()
    wide = cells.select("cell_id", *(cell_to_parent("cell_id", r).alias(f"res_{r}") for r in range(8)), cell_to_parent("cell_id", 8).alias("finer"))
    return wide


def _strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _occurrences(spark, sf_dir).select("cell_id").distinct()
    text = cell_to_string("cell_id")
    return cells.select("cell_id", text.alias("hexid"), string_to_cell(text).alias("back"), resolution("cell_id").alias("res"))


def _lgamma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ln gamma, and both forms of the expected species, over sizes as they occur."""
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_partkey").cast("long").alias("x")).distinct()
    size = F.col("x") + F.lit(100)
    by_product, by_lgamma = es_term(size, F.lit(7), 50), F.lit(1.0) - F.exp(lgamma(size - 6) + lgamma(size - 49) - lgamma(size - 56) - lgamma(size + 1))
    return n.select("x", F.round(lgamma(F.col("x")), 6).alias("ln_gamma"), F.round(by_product, 6).alias("by_product"), F.round(by_lgamma, 6).alias("by_lgamma"))


def _grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _occurrences(spark, sf_dir).select(cell_to_string(cell_to_parent("cell_id", 6)).alias("hexid")).distinct().withColumn("geometry", F.lit("POLYGON EMPTY"))
    found = _base(spark, sf_dir).select(cell_to_string(cell_to_parent("cell_id", 6)).alias("cell"), "species", "records")
    joined = grid.join_grid(cells, indicators.calc_indicators(found))
    return _even(joined.select("hexid", "n", "sp", "shannon"))


def _map_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = indicators.calc_indicators(_events(spark, sf_dir)).withColumn("hexid", F.col("cell").cast("string")).withColumn("geometry", F.lit("POLYGON EMPTY"))
    return _even(grid.map_layer(found, "es", "ES50", "log10").select("hexid", "fill", "label"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places spread over the globe, with their cells at several resolutions, and the centres of these."""
    places = _sql(spark, sf_dir, "SELECT DISTINCT (l_partkey * 7919) % 36000 / 100D - 180 AS lng, (l_orderkey * 104729) % 18000 / 100D - 90 AS lat FROM lineitem")
    found = places.withColumn("res", F.explode(F.array(*map(F.lit, (0, 3, 7, 12))))).withColumn("cell_id", latlng_to_cell(F.col("lat"), F.col("lng"), F.col("res")))
    centred = found.withColumn("centre", cell_to_latlng(F.col("cell_id")))
    return centred.select("lng", "lat", "res", "cell_id", cell_to_string("cell_id").alias("hexid"), F.round("centre.lng", 6).alias("centre_lng"), F.round("centre.lat", 6).alias("centre_lat"))


#: The Robinson projection of whole degrees in SQL, by cubics through four rows of its table.
_ROBINSON_SQL = f"""
WITH places AS (SELECT DISTINCT decimalLongitude AS lng, decimalLatitude AS lat FROM ({OCCURRENCES}) WHERE decimalLatitude IS NOT NULL),
placed AS (SELECT *, abs(lat) / 5 AS steps, least(floor(abs(lat) / 5), 16) AS low FROM places),
held AS (
    SELECT lng, lat, steps - low AS s, CAST(low AS INTEGER) AS k,
      [{", ".join(map(str, (LENGTH[1], *LENGTH)))}] AS length, [{", ".join(map(str, (-DISTANCE[1], *DISTANCE)))}] AS distance FROM placed
), bent AS (
    SELECT lng, lat, {", ".join(f"{v}[k + 1] * s * (s - 1) * (s - 2) / -6 + {v}[k + 2] * (s + 1) * (s - 1) * (s - 2) / 2 - {v}[k + 3] * (s + 1) * s * (s - 2) / 2 + {v}[k + 4] * (s + 1) * s * (s - 1) / 6 AS {v}" for v in ("length", "distance"))} FROM held
)
SELECT lng, lat, round({FACTORS[0]} * {RADIUS} * length * radians(lng), 3) + 0.0 AS x, round({FACTORS[1]} * {RADIUS} * distance * sign(lat), 3) + 0.0 AS y FROM bent"""


def _robinson(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _occurrences(spark, sf_dir).where("decimalLatitude IS NOT NULL").select(F.col("decimalLongitude").alias("lng"), F.col("decimalLatitude").alias("lat")).distinct()
    x, y = robinson(F.col("lng"), F.col("lat"))
    return places.select("lng", "lat", (F.round(x, 3) + 0.0).alias("x"), (F.round(y, 3) + 0.0).alias("y"))


def _binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicator layer of occurrences binned by their own places."""
    base = stores.base_records(_occurrences(spark, sf_dir).drop("cell_id"))
    return _even(stores.index_of(base).withColumn("res", F.col("res").cast("int")))


def _grid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of each resolution, and how many of them are within a cell of the next coarser one."""
    found = None
    for res in range(5):
        cells = all_cells(spark, res).select(F.lit(res).alias("res"), "cell_id", cell_to_parent("cell_id", max(0, res - 1)).alias("parent"))
        found = cells if found is None else found.unionByName(cells)
    return found.groupBy("res").agg(F.count_distinct("cell_id").alias("cells"), F.count_distinct("parent").alias("parents"))


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.occurrence_sample(_normal(spark, sf_dir), 500)


def _sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a sample of duplicates' counts: how many rows it has, how many of them differ, and how many are rows of the whole."""
    whole = datasets.count_duplicates(_normal(spark, sf_dir))
    sample = datasets.sample_exactly(whole, 500)
    return sample.agg(F.count("*").alias("rows")).crossJoin(sample.distinct().agg(F.count("*").alias("distinct_rows"))).crossJoin(sample.intersect(whole).agg(F.count("*").alias("found")))


_STORES: dict[tuple[str, str], stores.Store] = {}


def written_store(spark: SparkSession, sf_dir: str) -> stores.Store:
    """A store of the driver's tables on shared storage, built once for each application and folder of tables."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _STORES:
        path = new_path(spark, "store")
        stores.build_store(spark, _occurrences(spark, sf_dir), path)
        _STORES[key] = stores.Store(spark, path)
    return _STORES[key]


def _from_store(indicator: str, res: int, **request) -> Query:
    return lambda spark, sf_dir: _even(tiles.tile_query(written_store(spark, sf_dir), tiles.TileRequest(indicator, **request), res))


def _served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile as a server gives it: from a URL, over a written store, the first cells by id."""
    store = written_store(spark, sf_dir)
    url = tiles.tile_url("https://tiles.example.org/{z}/{x}/{y}", tiles.TileRequest("sp", **_FILTERED), db="fauna")
    return _even(tiles.serve({"fauna": store}, url, 6, max_rows=20))


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicator layer of a store that is built, written and read again."""
    return _even(written_store(spark, sf_dir).idx().withColumn("res", F.col("res").cast("int")).select("res", "cell_id", "n", "sp", "shannon", "simpson", "es"))


def _flat(choose: Callable[[DataFrame], DataFrame]) -> Query:
    def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
        kept = choose(_normal(spark, sf_dir))
        return kept.groupBy("decimalLongitude", "decimalLatitude", "species").agg(F.count("*").alias("rows"), F.sum("records").alias("records"))

    return counted


def _flat_sql(where: str) -> str:
    return f"SELECT decimalLongitude, decimalLatitude, species, count(*) AS rows, CAST(sum(records) AS BIGINT) AS records FROM ({OCCURRENCES}) WHERE {where} GROUP BY 1, 2, 3"


def _box_sql(box: tuple[float, ...]) -> str:
    return f"decimalLongitude BETWEEN {box[0]} AND {box[2]} AND decimalLatitude BETWEEN {box[1]} AND {box[3]}"


_DUPLICATES = "SELECT decimalLongitude, decimalLatitude, species, date_year, count(*) AS records FROM ({}) WHERE species IS NOT NULL{} GROUP BY 1, 2, 3, 4"


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = occurrences.normalise(_occurrences(spark, sf_dir).drop("class", "AphiaID", "dropped"))
    return found.groupBy("aphiaid", "class", "order", "family", "genus", "phylum").agg(F.count("*").alias("rows"))


_FILTERED = {"taxon": {"class": "Brand#2"}, "years": (1996, 1996)}
_FILTERED_SQL = "class = 'Brand#2' AND date_year >= 1996 AND date_year <= 1996"
_MULTI = {"taxon": {"phylum": "ECONOMY", "class": ["Brand#2", "Brand#3"]}, "years": (1996, 1997)}
_MULTI_SQL = "phylum = 'ECONOMY' AND class IN ('Brand#2', 'Brand#3') AND date_year BETWEEN 1996 AND 1997"


def _pairs() -> dict[str, tuple[Query, str | None]]:
    """Each query with its SQL, or None where another engine has no such function."""
    found: dict[str, tuple[Query, str | None]] = {
        "calc_indicators": (_calc(_events, _ALL), _indicator_sql(_EVENT_TOTALS, "cell", _ALL)),
        "calc_indicators_lineitem": (_calc(_by_line, _ALL), _indicator_sql(_LINE_TOTALS, "cell", _ALL)),
        "indicators_all_null_es": (_calc(_few, _ALL), _indicator_sql(_FEW_TOTALS, "cell", _ALL)),
        "hill_numbers": (_calc(_events, ["hill_1", "hill_2", "hill_inf"]), _indicator_sql(_EVENT_TOTALS, "cell", ["hill_1", "hill_2", "hill_inf"])),
        "lgamma_es_parity": (_lgamma, None),
        "species_totals": (lambda s, d: indicators.species_totals(_events(s, d), "cell"), f"SELECT cell, species, CAST(sum(records) AS BIGINT) AS ni FROM ({EVENTS}) GROUP BY 1, 2"),
        "dedupe_counts": (lambda s, d: datasets.count_duplicates(_normal(s, d)), _DUPLICATES.format(OCCURRENCES, "")),
        "filter_not_null": (_flat(occurrences.known), _flat_sql(_VALID)),
        "filter_flags": (_flat(occurrences.present), _flat_sql("dropped IS NOT TRUE AND absence IS NOT TRUE")),
        "filter_bbox": (_flat(lambda df: occurrences.within(df, BOX)), _flat_sql(_box_sql(BOX))),
        "filter_cleaned": (_flat(lambda df: occurrences.cleaned(df, BOX)), _flat_sql(f"{_KEPT} AND {_box_sql(BOX)}")),
        "region_south_atlantic": (lambda s, d: datasets.south_atlantic(_normal(s, d)), _DUPLICATES.format(OCCURRENCES, f" AND {_box_sql(datasets.SOUTH_ATLANTIC)}")),
        "region_florida_keys_as_published": (lambda s, d: datasets.florida_keys_as_published(_normal(s, d)), _DUPLICATES.format(OCCURRENCES, f" AND {_box_sql(datasets.FLORIDA_KEYS_AS_PUBLISHED)}")),
        "missing_columns_null": (_missing, f"SELECT CAST(NULL AS BIGINT) AS aphiaid, CAST(NULL AS VARCHAR) AS class, CAST(NULL AS VARCHAR) AS \"order\", CAST(NULL AS VARCHAR) AS family, CAST(NULL AS VARCHAR) AS genus, phylum, count(*) AS rows FROM ({OCCURRENCES}) GROUP BY phylum"),
        "nested_source_normalize": (_nested, _BASE_SQL),
        "records_sum_vs_count": (_counted, f"SELECT cell_id, species, CAST(sum(records) AS BIGINT) AS summed, count(*) AS counted FROM ({OCCURRENCES}) WHERE {_KEPT} GROUP BY 1, 2"),
        "cell_to_parent": (_parents, f"SELECT DISTINCT cell_id, {', '.join(f'{_parent_sql('cell_id', r)} AS res_{r}' for r in range(8))}, CAST(NULL AS BIGINT) AS finer FROM ({OCCURRENCES})"),
        "cell_to_string": (_strings, f"SELECT DISTINCT cell_id, lower(hex(cell_id)) AS hexid, cell_id AS back, 7 AS res FROM ({OCCURRENCES})"),
        "occ_h3_base": (lambda s, d: _base(s, d).select("cell_id", "aphiaid", "phylum", "class", "species", "date_year", "records"), _BASE_SQL),
        "occ_h3_tiers": (_tiers, f"WITH base AS ({_BASE_SQL}) " + " UNION ALL ".join(map(_tier_sql, TIERS))),
        "idx_h3_multires": (_index, _index_sql()),
        "store_round_trip": (_written, _index_sql()),
        "tile_filtered_multi_taxon": (_tile("es", 4, **_MULTI), _tile_sql(4, "es", _MULTI_SQL)),
        "tile_years_open_ended": (_tile("sp", 5, taxon={"class": "Brand#2"}, years=(1998, None)), _tile_sql(5, "sp", "class = 'Brand#2' AND date_year >= 1998")),
        "tile_species": (_tile("es", 7, taxon={"species": "small ring"}), _tile_sql(7, "es", "species = 'small ring'")),
        "tile_res_cap": (_tile("sp", 7, res_max=4), _tile_sql(4, "sp")),
        "tile_filtered_res_cap": (_tile("shannon", 9, res_max=2, **_FILTERED), _tile_sql(2, "shannon", _FILTERED_SQL)),
        "tile_unfiltered_res_0": (_tile("sp", 0), f"SELECT * FROM ({_tile_sql(1, 'sp')}) WHERE FALSE"),
        "tile_filtered_res_0": (_tile("sp", 0, **_FILTERED), _tile_sql(0, "sp", _FILTERED_SQL)),
        "tile_stats": (
            lambda s, d: _even(tiles.tile_stats(_InMemory(s, d), tiles.TileRequest("shannon"), 6)),
            f"SELECT {_round('min(value)')} AS min, {_round('max(value)')} AS max, {_round('quantile_cont(value, 0.02)')} AS p02, {_round('quantile_cont(value, 0.98)')} AS p98, count(value) AS n FROM ({_tile_sql(6, 'shannon').replace(_MEASURES['shannon'], 'sum(-p * ln(p))')})",
        ),
        "tile_json": (
            lambda s, d: tiles.tile_json(tiles.tile_query(_InMemory(s, d), tiles.TileRequest("n"), 6)),
            f"SELECT '{{\"h3id\":\"' || lower(hex(cell_id)) || '\",\"value\":' || CAST(value AS VARCHAR) || ',\"n\":' || CAST(n AS VARCHAR) || '}}' AS cell FROM ({_tile_sql(6, 'n')})",
        ),
        "grid_join": (
            _grid_join,
            _indicator_sql(f"SELECT lower(hex({_parent_sql('cell_id', 6)})) AS hexid, species, sum(records) AS ni FROM ({_BASE_SQL}) GROUP BY 1, 2", "hexid", ["n", "sp", "shannon"]),
        ),
        "map_layer": (_map_layer, f"SELECT CAST(cell AS VARCHAR) AS hexid, {_round('log10(v)')} AS fill, 'ES50' AS label FROM ({_indicator_sql(_EVENT_TOTALS, 'cell', ['es']).replace(_MEASURES['es'] + ' AS es', 'sum(esi) AS v')})"),
        "sample_exact_n": (_sample, None),
        "sample_counts": (_sample_counts, f"SELECT least(500, count(*)) AS rows, least(500, count(*)) AS distinct_rows, least(500, count(*)) AS found FROM ({_DUPLICATES.format(OCCURRENCES, '')})"),
        "store_tile_es": (_from_store("es", 6), _tile_sql(6, "es")),
        "store_tile_filtered_shannon": (_from_store("shannon", 4, **_MULTI), _tile_sql(4, "shannon", _MULTI_SQL)),
        "store_tile_stats": (
            lambda s, d: _even(tiles.tile_stats(written_store(s, d), tiles.TileRequest("es"), 7)),
            f"SELECT {_round('min(value)')} AS min, {_round('max(value)')} AS max, {_round('quantile_cont(value, 0.02)')} AS p02, {_round('quantile_cont(value, 0.98)')} AS p98, count(value) AS n FROM ({_tile_sql(7, 'es').replace(_MEASURES['es'], 'sum(esi)')})",
        ),
        "served_tile": (_served, f"SELECT * FROM ({_tile_sql(6, 'sp', _FILTERED_SQL)}) ORDER BY cell_id LIMIT 20"),
        "latlng_to_cell": (_places, None),
        "robinson_points": (_robinson, _ROBINSON_SQL),
        "projected_extent": (lambda s, d: grid.projected_extent(_occurrences(s, d).select("cell_id").distinct()), None),
        "binned_index": (_binned, None),
        "make_grid": (lambda s, d: grid.make_grid(s, 2), None),
        "grid_cell_counts": (_grid_counts, "SELECT r AS res, CAST(2 + 120 * power(7, r) AS BIGINT) AS cells, CAST(2 + 120 * power(7, greatest(r - 1, 0)) AS BIGINT) AS parents FROM (SELECT CAST(unnest(range(5)) AS INTEGER) AS r)"),
    }
    for esn in (10, 50, 100):
        found[f"es_{esn}"] = (_calc(_events, ["es"], esn), _indicator_sql(_EVENT_TOTALS, "cell", ["es"], esn))
    found["es_fractional"] = (_calc(_events, ["es"], 20.5), _indicator_sql(_EVENT_TOTALS, "cell", ["es"], 20.5))
    for name, what in (("richness", "sp"), ("shannon", "shannon"), ("simpson", "simpson"), ("maxp", "maxp")):
        found[name] = (_calc(_events, [what]), _indicator_sql(_EVENT_TOTALS, "cell", [what]))
    for first in range(1995, 2001, 2):
        found[f"years_{first}_{first + 2}"] = (
            lambda s, d, first=first: datasets.between_years(datasets.count_duplicates(_normal(s, d)), first, first + 2),
            _DUPLICATES.format(OCCURRENCES, f" AND date_year BETWEEN {first} AND {first + 2}"),
        )
    for name, (first, last) in datasets.DECADES.items():
        found[f"decade_{name}"] = (lambda s, d, name=name: datasets.decade(_earlier(s, d), name), _DUPLICATES.format(EARLIER, f" AND date_year BETWEEN {first} AND {last}"))
    for indicator in INDICATORS:
        found[f"tile_default_{indicator}"] = (_tile(indicator, 6), _tile_sql(6, indicator))
        found[f"tile_filtered_{indicator}"] = (_tile(indicator, 6, **_FILTERED), _tile_sql(6, indicator, _FILTERED_SQL))
    return found


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _pairs().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _pairs().items() if sql}
