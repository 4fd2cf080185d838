from datetime import date

import numpy as np
import pytest
from faunagrid.functions.h3core import cell_to_latlng
from faunagrid.plans import registry, tiles
from faunagrid.plans.store import Store, base_records, build_store, dated, publish, published
from faunagrid.plans.tiles import TileRequest, checked_sql, decode_tile_url, h3j, serve, tile_query, tile_sql, tile_url
from faunagrid.schema import IDX, INDEX_RES, INDICATORS, OCC
from pyspark.sql import functions as F

from tests.oracle import SF_DIR


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stores") / "one")
    build_store(spark, registry._occurrences(spark, SF_DIR), path)
    return Store(spark, path)


def rows(df):
    return sorted((r.cell_id, None if r.value is None else round(r.value, 6), r.n) for r in df.select("cell_id", "value", "n").collect())


def test_layers(store):
    assert {r.res for r in store.occ().select("res").distinct().collect()} == {3, 5, 7}
    assert {r.res for r in store.idx().select("res").distinct().collect()} == {*range(1, 8)}
    assert store.occ().schema == OCC and store.idx().schema == IDX


def test_binned_index_has_all_levels(spark):
    assert sorted(r.res for r in registry._binned(spark, SF_DIR).select("res").distinct().collect()) == [*INDEX_RES]


def test_reading_one_resolution_prunes(store):
    plan = tile_query(store, TileRequest("sp"), 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(res" in plan


def test_overwrite_guard(spark, store):
    with pytest.raises(FileExistsError):
        build_store(spark, registry._occurrences(spark, SF_DIR), store.path, overwrite=False)
    before = store.idx().count()
    with pytest.raises(ValueError):
        build_store(spark, spark.range(3), store.path)  # a failed build leaves the old store
    assert store.idx().count() == before


def test_region_and_paths(spark, tmp_path):
    registry._occurrences(spark, SF_DIR).write.parquet(str(tmp_path / "raw"))
    path = build_store(spark, [str(tmp_path / "raw")], str(tmp_path / "store"), region_bbox=(-60, -45, 90, 45), esn=10)
    small = Store(spark, path)
    assert 0 < small.occ().count() < base_records(registry._occurrences(spark, SF_DIR)).count()


@pytest.mark.parametrize("indicator", INDICATORS)
@pytest.mark.parametrize("filters", [{}, {"taxon": {"class": "Brand#2"}, "years": (1996, None)}, {"taxon": {"phylum": ["ECONOMY", "PROMO"]}}])
def test_urls_serve_what_requests_compute(store, indicator, filters):
    request = TileRequest(indicator, res_max=6, **filters)
    url = tile_url("https://tiles.example.org/{z}/{x}/{y}", request, release="r7", db="fauna")
    assert url.startswith("https://tiles.example.org/{z}/{x}/{y}?q=") and url.endswith("&release=r7&db=fauna")
    assert decode_tile_url(url) == tile_sql(request)
    for res in (2, 5, 9):
        assert rows(serve({"fauna": store}, url, res)) == rows(tile_query(store, request, res))


def test_sql_text():
    for indicator in INDICATORS:
        text = tile_sql(TileRequest(indicator))
        assert "idx_h3" in text and "{{res}}" in text
    text = tile_sql(TileRequest("es", {"class": "Aves"}, (2000, 2020)))
    assert all(x in text for x in ("occ_h3", "lgamma", '"class" = \'Aves\'', "date_year >= 2000", "date_year <= 2020"))
    assert "'a'' OR ''1''=''1'" in tile_sql(TileRequest("n", {"genus": "a' OR '1'='1"}))


@pytest.mark.parametrize("value", ["zz\\' OR 1=1 -- ", "a' OR '1'='1", "zz' OR TRUE OR 'a' = 'a"])
def test_no_value_becomes_sql(store, value):
    request = TileRequest("n", {"genus": value})
    assert tile_query(store, request, 5).count() == 0
    try:
        assert serve({"fauna": store}, tile_url("x", request), 5).count() == 0
    except ValueError:
        pass  # refused


def test_requests_are_checked():
    for bad in ({"taxon": {"badrank": "x"}}, {"taxon": {"class": []}}, {"indicator": "sh"}, {"years": (1,)}, {"esn": "50; DROP"}):
        with pytest.raises(ValueError):
            TileRequest(**bad)


@pytest.mark.parametrize(
    "text",
    [
        "DROP TABLE x",
        "SELECT 1; SELECT 2",
        "WITH a AS (SELECT 1) INSERT INTO b SELECT * FROM a",
        "SET spark.sql.ansi.enabled=false",
        "SELECT cell_id, reflect('java.lang.System', 'getProperty', 'user.dir') AS value, n FROM idx_h3",
        "SELECT cell_id, java_method('java.lang.System', 'getProperty', 'user.dir') AS value, n FROM idx_h3",
        "SELECT cell_id, try_reflect('java.lang.System', 'getProperty', 'user.dir') AS value, n FROM idx_h3",
        "SELECT cell_id, sp AS value, n FROM parquet.`/root/testdata/sf0.001/region.parquet`",
        "SELECT cell_id, sp AS value, n FROM text.\"/etc/passwd\"",
        "SELECT id AS cell_id, 1 AS value, 1 AS n FROM range(1000000000)",
        "SELECT cell_id, (SELECT max(value) FROM text.`/etc/passwd`) AS value, n FROM idx_h3",
        "SELECT cell_id, sp AS value, n FROM idx_h3 WHERE cell_id IN (SELECT cell_id FROM other)",
        "SELECT cell_id, sp AS value, n FROM other",
        "SELECT a.cell_id, 1 AS value, 1 AS n FROM idx_h3 a, text.`/etc/passwd` b",
        "SELECT TRANSFORM(cell_id) USING 'cat' AS (cell_id) FROM idx_h3",
        "WITH t AS (SELECT * FROM csv.`/etc/passwd`) SELECT 1 AS cell_id, 1 AS value, 1 AS n FROM t",
        "SELECT cell_id, input_file_name() AS value, n FROM idx_h3",
        "SELECT cell_id, value, n FROM idx_h3 LATERAL VIEW explode(array(1)) t AS value",
        "SELECT cell_id, x -> x AS value, n FROM idx_h3",
        "VALUES (1, 2, 3)",
        "SELECT 'a\\' OR 1=1 --' AS cell_id",
    ],
)
def test_other_sql_is_refused(spark, store, text):
    with pytest.raises(ValueError):
        serve({"fauna": store}, tile_url("x", sql=text), 3)
    with pytest.raises(ValueError):
        checked_sql(spark.newSession(), text, 3)


def test_own_sql_is_served_in_a_box_and_capped(spark, store):
    url = tile_url("x", sql="SELECT cell_id, MAX(sp) AS value, MAX(n) AS n FROM idx_h3 WHERE res = {{res}} AND n BETWEEN 1 AND 100000 GROUP BY cell_id")
    every = serve({"fauna": store}, url, 6).collect()
    assert len(every) == store.idx().where("res = 6").count() > 3
    centres = {r.cell_id: r.c for r in store.idx().where("res = 6").select("cell_id", cell_to_latlng(F.col("cell_id")).alias("c")).collect()}
    box = (-100.0, 50.0, 60.0, 85.0)
    inside = sorted(k for k, c in centres.items() if c.lng is not None and -100 <= c.lng <= 60 and 50 <= c.lat <= 85)
    assert 0 < len(inside) < len(every)
    assert sorted(r.cell_id for r in serve({"fauna": store}, url, 6, box).collect()) == inside
    assert [r.cell_id for r in serve({"fauna": store}, url, 6, box, 2).collect()] == inside[:2]
    assert not spark.catalog.tableExists("idx_h3")  # nothing is left in the caller's session


def test_levels_are_rolled_up_once(spark, store):
    """Each level is computed from the finer one, whose rows are dealt once: the source is read once or twice, not by each level."""
    from faunagrid.plans.store import index_of

    index = index_of(base_records(registry._occurrences(spark, SF_DIR)))
    index.collect()
    plan = index._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 5 and plan.count("FileScan") <= 4


def test_samples_are_exact_and_agree(spark):
    from faunagrid.operators.datasets import sample_exactly

    df = spark.range(5000).select((F.col("id") % 700).alias("a"), F.lit("x").alias("b"))
    rows = sorted(df.collect())
    for n in (0, 1, 77, 4999, 5000, 9000):
        got = sorted(sample_exactly(df, n).collect())
        assert len(got) == min(n, 5000) and got == sorted(sample_exactly(df.repartition(3), n).collect())
        assert not [x for x in {*got} if got.count(x) > rows.count(x)]
    same = spark.range(3000).select(F.lit(1).alias("a"))
    assert sample_exactly(same, 1234).count() == 1234


def test_stats_are_exact(spark):
    from faunagrid.operators.indicators import summary

    for values in ([], [None], [3.0], [1.0, 2.0], [float(i * i % 997) for i in range(4000)], [1.0] * 50 + [2.0] * 3000):
        got = summary(spark.createDataFrame([(x,) for x in values], "value double")).first()
        known = np.array([x for x in values if x is not None])
        assert got.n == len(known)
        if len(known):
            assert tuple(got)[:4] == pytest.approx((known.min(), known.max(), *np.quantile(known, [0.02, 0.98])))
        else:
            assert tuple(got)[:4] == (None,) * 4


def test_json_document(store):
    import json

    cells = json.loads(h3j(tile_query(store, TileRequest("n"), 6), 3))["cells"]
    assert len(cells) == 3 and all(isinstance(c["h3id"], str) and {"value", "n"} < {*c} for c in cells)


def test_publishing(spark, store, tmp_path):
    root = store.path.rsplit("/", 1)[0]
    publish(spark, root, "one")
    assert published(spark, root).path == store.path
    folder = dated(spark, registry._occurrences(spark, SF_DIR), root, date(2024, 5, 6), region_bbox=(0, 0, 90, 45))
    assert folder.endswith("/v2024-05-06") and published(spark, root).path == folder
    publish(spark, f"file://{root}", "one")  # over the file of the last one
    assert published(spark, root).path == store.path
    with pytest.raises(FileNotFoundError):
        publish(spark, root, "none")


def test_streamed_batches_add_up(spark, tmp_path):
    from faunagrid.streaming.maintain import base_of, follow

    source = registry._occurrences(spark, SF_DIR)
    half = source.randomSplit([0.5, 0.5], 1)
    for i, part in enumerate(half):
        part.write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    follow(stream, str(tmp_path / "base"), str(tmp_path / "checkpoint")).awaitTermination()
    key = lambda r: tuple(str(x) for x in r)
    expected = base_records(source)
    assert sorted(base_of(spark, str(tmp_path / "base")).select(expected.columns).collect(), key=key) == sorted(expected.collect(), key=key)
    assert tiles.tier_of(4) == 5
