"""Map tiles: requests, the queries they stand for, their SQL text and URLs, and JSON for the map.

A request without filters reads the indicator store. With filters it computes the indicator from
the coarsest tier of the species store that is fine enough. Requests are run as DataFrames; the SQL
text is for clients of a tile server.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import parse_qs, quote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faunagrid.functions.cells import cell_to_parent, cell_to_string
from faunagrid.functions.h3core import cell_to_latlng
from faunagrid.operators.indicators import indicators_of, summary
from faunagrid.plans.store import Store
from faunagrid.schema import BASE_RES, ESN, INDICATORS, RANKS, TIERS

PLACEHOLDER = "{{res}}"


@dataclass(frozen=True)
class TileRequest:
    """``taxon``: rank to one value or several; ``years``: first and last, either may be None."""

    indicator: str = "es"
    taxon: Mapping[str, str | Sequence[str]] = field(default_factory=dict)
    years: tuple[int | None, int | None] | None = None
    esn: float = ESN
    res_max: int = BASE_RES

    def __post_init__(self) -> None:
        if self.indicator not in INDICATORS:
            raise ValueError(f"unknown indicator: {self.indicator}")
        if unknown := [r for r in self.taxon if r not in RANKS]:
            raise ValueError(f"no such rank: {', '.join(map(str, unknown))}")
        for rank, values in self.taxa().items():
            if not values or not all(isinstance(v, str) for v in values):
                raise ValueError(f"{rank} needs one name or several")
        if self.years is not None and len(self.years) != 2:
            raise ValueError("years are a first and a last one")
        if isinstance(self.esn, bool) or not isinstance(self.esn, int | float):
            raise ValueError("the sample size must be a number")

    def taxa(self) -> dict[str, list[str]]:
        return {r: [v] if isinstance(v, str) else list(v) for r, v in self.taxon.items()}

    @property
    def bounds(self) -> tuple[int | None, int | None]:
        first, last = self.years or (None, None)
        return (None if first is None else int(first), None if last is None else int(last))

    @property
    def filtered(self) -> bool:
        return bool(self.taxon) or self.bounds != (None, None)

    @property
    def cap(self) -> int:
        return max(1, min(BASE_RES, int(self.res_max)))


def tier_of(res: int) -> int:
    """The coarsest tier that is at least as fine."""
    return next((t for t in TIERS if res <= t), TIERS[-1])


def filtered_records(occ: DataFrame, request: TileRequest) -> DataFrame:
    """Values and years are compared as columns, so that no text of a request becomes SQL."""
    for rank, values in request.taxa().items():
        column = F.col(f"`{rank}`")
        occ = occ.where(column == F.lit(values[0]) if len(values) == 1 else column.isin(values))
    first, last = request.bounds
    if first is not None:
        occ = occ.where(F.col("date_year") >= first)
    return occ if last is None else occ.where(F.col("date_year") <= last)


def tile_query(store: Store, request: TileRequest, res: int) -> DataFrame:
    """(cell_id, value, n) at a tile's resolution, or the request's cap if that is coarser."""
    shown = min(int(res), request.cap)
    if not request.filtered:
        return store.idx().where(F.col("res") == shown).select("cell_id", F.col(request.indicator).cast("double").alias("value"), "n")
    occ = filtered_records(store.occ().where(F.col("res") == tier_of(shown)), request)
    totals = occ.groupBy(cell_to_parent("cell_id", shown).alias("cell_id"), "species").agg(F.sum("records").alias("ni"))
    if request.indicator in ("n", "sp"):
        found = totals.groupBy("cell_id").agg(F.sum("ni").alias("n"), F.count("*").alias("sp"))
    else:
        found = indicators_of(totals, "cell_id", esn=request.esn)
    return found.select("cell_id", F.col(request.indicator).cast("double").alias("value"), "n")


def in_tile(cells: DataFrame, box: Sequence[float], max_rows: int | None = None) -> DataFrame:
    """Cells whose centre lies in (lon_min, lat_min, lon_max, lat_max); the first ``max_rows`` by id."""

    lon_min, lat_min, lon_max, lat_max = map(float, box)
    centre = cells.withColumn("_centre", cell_to_latlng(F.col("cell_id")))
    found = centre.where(F.col("_centre.lng").between(lon_min, lon_max) & F.col("_centre.lat").between(lat_min, lat_max)).drop("_centre")
    return found if max_rows is None else found.orderBy("cell_id").limit(int(max_rows))


def tile_stats(store: Store, request: TileRequest, res: int) -> DataFrame:
    return summary(tile_query(store, request, res), "value")


def tile_json(cells: DataFrame) -> DataFrame:
    """One JSON text per cell. Ids are hexadecimal strings, since they exceed what JSON readers keep exactly."""
    return cells.select(F.to_json(F.struct(cell_to_string("cell_id").alias("h3id"), "value", "n")).alias("cell"))


def h3j(cells: DataFrame, max_rows: int) -> str:
    """The document of a tile, of at most ``max_rows`` cells: what one response holds."""
    rows = tile_json(cells.orderBy("cell_id").limit(int(max_rows))).collect()
    return '{"cells":[' + ",".join(r.cell for r in rows) + "]}"


def _literal(text: str) -> str:
    """A string literal in which neither quotes nor backslashes end it."""
    return "'" + text.replace("\\", "\\\\").replace("'", "''") + "'"


def tile_sql(request: TileRequest, placeholder: str = PLACEHOLDER) -> str:
    """The request as one SELECT of cell_id, value and n, for a server with tables idx_h3 and occ_h3."""
    if not re.fullmatch(r"[{}\w]+", placeholder):
        raise ValueError(f"not a placeholder: {placeholder!r}")
    shown = f"LEAST({placeholder}, {request.cap})"
    if not request.filtered:
        return f"SELECT cell_id, {request.indicator} AS value, n FROM idx_h3 WHERE res = {shown}"
    tests = [f'"{rank}" = {_literal(v[0])}' if len(v) == 1 else f'"{rank}" IN ({", ".join(map(_literal, v))})' for rank, v in request.taxa().items()]
    first, last = request.bounds
    tests += [f"date_year >= {first}"] * (first is not None) + [f"date_year <= {last}"] * (last is not None)
    tier = " ".join(f"WHEN {shown} <= {t} THEN {t}" for t in TIERS[:-1])
    totals = (
        f"SELECT CAST(h3_cell_to_parent(cell_id, {shown}) AS BIGINT) AS cell_id, species, SUM(records) AS ni FROM occ_h3"
        f" WHERE res = CASE {tier} ELSE {TIERS[-1]} END AND {' AND '.join(tests)} GROUP BY 1, 2"
    )
    if request.indicator in ("n", "sp"):
        value = "SUM(ni)" if request.indicator == "n" else "COUNT(*)"
        return f"WITH totals AS ({totals}) SELECT cell_id, {value} AS value, SUM(ni) AS n FROM totals GROUP BY cell_id"
    m = request.esn
    term = {
        "shannon": "-(CAST(ni AS DOUBLE) / n) * ln(CAST(ni AS DOUBLE) / n)",
        "es": f"CASE WHEN n - ni >= {m} THEN 1 - exp(lgamma(n - ni + 1) + lgamma(n - {m} + 1) - lgamma(n - ni - {m} + 1) - lgamma(n + 1)) WHEN n >= {m} THEN 1 END",
    }[request.indicator]
    return f"WITH totals AS ({totals}), shares AS (SELECT cell_id, ni, SUM(ni) OVER (PARTITION BY cell_id) AS n FROM totals) SELECT cell_id, SUM({term}) AS value, MAX(n) AS n FROM shares GROUP BY cell_id"


def tile_url(base_url: str, request: TileRequest | None = None, sql: str | None = None, release: str | None = None, db: str | None = None) -> str:
    """``base_url`` with the SQL in Base64 as q, and the release and the name of the store."""
    text = tile_sql(request or TileRequest()) if sql is None else sql
    url = f"{base_url}?q={quote(base64.b64encode(text.encode()).decode(), safe='')}"
    for name, value in (("release", release), ("db", db)):
        if value is not None:
            url += f"&{name}={quote(value, safe='')}"
    return url


def decode_tile_url(url: str) -> str:
    return base64.b64decode(parse_qs(urlsplit(url).query)["q"][0], validate=True).decode()


#: What a client's SQL may hold: the tables of a store, functions, and the classes of parsed plans and expressions.
TABLES = ("occ_h3", "idx_h3")
FUNCTIONS = frozenset("sum count min max avg ln log log2 log10 exp sqrt power abs round floor ceil least greatest coalesce nullif lgamma h3_cell_to_parent between".split())
_PLANS = "UnresolvedWith SubqueryAlias Project Filter Aggregate Join Sort GlobalLimit LocalLimit Distinct Union UnresolvedRelation UnresolvedHaving"
_EXPRESSIONS = (
    "Alias UnresolvedAlias UnresolvedAttribute UnresolvedStar UnresolvedOrdinal UnresolvedFunction Literal And Or Not EqualTo EqualNullSafe GreaterThan "
    "GreaterThanOrEqual LessThan LessThanOrEqual In IsNull IsNotNull UnresolvedBetween Between CaseWhen Add Subtract Multiply Divide UnaryMinus Cast SortOrder "
    "WindowExpression WindowSpecDefinition UnspecifiedFrame$"
)
_CLASSES = frozenset((_PLANS + " " + _EXPRESSIONS).split())
#: Cells of one tile at most.
MAX_ROWS = 50_000


def checked_sql(spark: SparkSession, text: str, res: int, placeholder: str = PLACEHOLDER) -> str:
    """A client's SQL with the resolution in place. It is parsed, not run; a plan that holds anything not listed above is refused."""
    text = text.replace(placeholder, str(int(res)))
    if "\\" in text:
        raise ValueError("backslashes are not served")
    try:
        plan = json.loads(spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toJSON())
    except (ParseException, Py4JJavaError) as error:
        raise ValueError("only a single SELECT is served") from error
    with_names: set[str] = set()

    def walk(node: object) -> Iterator[dict]:
        if isinstance(node, dict):
            if "class" in node:
                yield node
            for name, value in node.items():
                if name == "cteRelations":
                    with_names.update(x["_1"].lower() for x in value)
                yield from walk(value)
        elif isinstance(node, list):
            for value in node:
                yield from walk(value)

    nodes = [*walk(plan)]
    for node in nodes:
        kind = node["class"].rpartition(".")[2]
        if kind not in _CLASSES:
            raise ValueError(f"not served: {kind}")
        if kind == "UnresolvedRelation" and node["multipartIdentifier"].strip("[]").lower() not in {*TABLES, *with_names}:
            raise ValueError(f"no such table: {node['multipartIdentifier']}")
        if kind == "UnresolvedFunction" and node["nameParts"].strip("[]").lower() not in FUNCTIONS:
            raise ValueError(f"no such function: {node['nameParts']}")
    return text


def serve(stores: Mapping[str, Store], url: str, res: int, box: Sequence[float] | None = None, max_rows: int = MAX_ROWS) -> DataFrame:
    """The cells of a tile URL, run in Spark over the store that it names (the first, if none).

    Only cells whose centre lies in ``box`` (lon_min, lat_min, lon_max, lat_max), the first ``max_rows`` by id. Each
    request has a session of its own, so that the tables of one store are never seen by another's.
    """
    query = parse_qs(urlsplit(url).query)
    name = query.get("db", [next(iter(stores))])[0]
    if name not in stores:
        raise ValueError(f"no such store: {name}")
    spark = stores[name].spark.newSession()
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    sql = checked_sql(spark, decode_tile_url(url), res)
    store = Store(spark, stores[name].path)
    register_functions(spark)
    store.occ().createOrReplaceTempView("occ_h3")
    store.idx().createOrReplaceTempView("idx_h3")
    found = spark.sql(sql)
    if sorted(found.columns) != ["cell_id", "n", "value"]:
        raise ValueError("a tile has the columns cell_id, value and n")
    found = found.select("cell_id", F.col("value").cast("double").alias("value"), "n")
    return in_tile(found, box, max_rows) if box else found.orderBy("cell_id").limit(int(max_rows))


def register_functions(spark: SparkSession) -> None:
    """h3_cell_to_parent and lgamma for SQL, as temporary SQL functions that Catalyst inlines."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION h3_cell_to_parent(c BIGINT, r INT) RETURNS BIGINT RETURN "
        "CASE WHEN r <= ((c >> 52) & 15) THEN ((c & ~(15L << 52)) | (CAST(r AS BIGINT) << 52)) | ((1L << (3 * (15 - r))) - 1) END"
    )
    below = " * ".join(f"(x + {i})" for i in range(8))
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION lgamma(x DOUBLE) RETURNS DOUBLE RETURN "
        "(x + 7.5D) * ln(x + 8) - (x + 8) + 0.91893853320467274178D + 1D / (12 * (x + 8)) - 1D / (360 * power(x + 8, 3)) + 1D / (1260 * power(x + 8, 5)) - 1D / (1680 * power(x + 8, 7)) - ln(" + below + ")"
    )
