import numpy as np
import pytest
from faunagrid.functions import h3core as h
from faunagrid.functions.cells import cell_to_parent, cell_to_string, string_to_cell
from faunagrid.operators.grid import extent, join_grid, make_grid, map_layer
from faunagrid.plans.tiles import in_tile
from pyspark.sql import functions as F

RNG = np.random.default_rng(7)
LAT, LNG = np.degrees(np.arcsin(RNG.uniform(-1, 1, 20000))), RNG.uniform(-180, 180, 20000)


def test_known_cells():
    assert h.encode(np.array([37.775938728915946]), np.array([-122.41795063018799]), 9)[0] == 0x8928308280FFFFF
    assert h.encode(np.array([37.3615593]), np.array([-122.0553238]), 5)[0] == 0x85283473FFFFFFF


def test_published_centres_and_corners():
    """Examples of the public specification's own documentation."""
    assert h.encode(np.array([40.689167]), np.array([-74.044444]), 10)[0] == 0x8A2A1072B59FFFF
    lat, lng = h.decode(np.array([0x85283473FFFFFFF]))
    assert (lat[0], lng[0]) == pytest.approx((37.34579337536848, -121.97637597255124), abs=1e-9)
    corners = {
        0x85283473FFFFFFF: [(37.271355866731895, -121.91508032705622), (37.353926450852256, -121.86222328902491), (37.42834118609435, -121.9235499963016), (37.42012867767778, -122.0377349642703), (37.33755608435298, -122.09042892904395), (37.26319797461824, -122.02910130919)],
        0x8A2A1072B59FFFF: [(40.690058601, -74.044151762), (40.689907695, -74.045061792), (40.689270936, -74.045341418), (40.688785091, -74.044711031), (40.688935993, -74.043801021), (40.689572744, -74.043521377)],
    }
    for cell, expected in corners.items():
        ring = [(lat, lng) for lng, lat in h.boundary(np.array([cell]))[0].tolist()]
        start = min(range(6), key=lambda k: np.abs(np.array(ring[k]) - expected[0]).sum())
        assert np.array(ring[start:] + ring[:start]) == pytest.approx(np.array(expected), abs=2e-9)


def test_base_cells_are_ordered_and_opposite():
    t = h.tables()
    centres = h._from_plane(t.home, h._point(t.start))
    assert (np.diff(centres[:, 2]) < 1e-9).all() and np.allclose(centres, -centres[::-1])
    assert np.flatnonzero(t.pentagon).tolist() == [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]


@pytest.mark.parametrize("res", [0, 1, 2, 3, 6, 7, 11, 15])
def test_centres_come_back(res):
    cells = h.encode(LAT, LNG, res)
    assert h.valid(cells).all()
    assert (h.encode(*h.decode(cells), res) == cells).all()


def test_every_cell_of_a_resolution_comes_back(spark):
    for res, n in ((0, 122), (1, 842), (2, 5882), (3, 41162)):
        cells = h.all_cells(spark, res).toPandas()["cell_id"].to_numpy()
        assert len({*cells.tolist()}) == n and h.valid(cells).all()
        assert (h.encode(*h.decode(cells), res) == cells).all()


def test_places_lie_within_their_cells():
    """A place is nearer to its cell's centre than to any other centre around it."""
    cells = h.encode(LAT, LNG, 3)
    corners = h.boundary(cells)
    for lat, lng, ring in zip(LAT[:3000], LNG[:3000], corners, strict=False):
        p = h._xyz(np.radians([lat]), np.radians([lng]))[0]
        q = h._xyz(np.radians(ring[:, 1]), np.radians(ring[:, 0]))
        sides = np.cross(q, np.roll(q, -1, axis=0)) @ p
        assert (sides > (-1e-9 if len(ring) == 6 else -1e-5)).all()  # counter-clockwise; a bent outline need not be quite convex


def test_corners_of_all_cells():
    pentagons = h.packed(np.flatnonzero(h.tables().pentagon), np.zeros((12, 2), np.int64), 2)
    assert {len(x) for x in h.boundary(pentagons)} == {5}
    assert {len(x) for x in h.boundary(h.encode(LAT[:500], LNG[:500], 4))} <= {5, 6}
    bent = h.packed(np.flatnonzero(h.tables().pentagon), np.zeros((12, 3), np.int64), 3)
    assert {len(x) for x in h.boundary(bent)} == {10}  # every side of an odd pentagon crosses an edge
    assert {len(x) for x in h.boundary(h.encode(LAT, LNG, 3))} == {6, 7, 8, 10}


@pytest.mark.parametrize("res", [0, 1, 2, 3])
def test_outlines_cover_the_globe_once(spark, res):
    """Sides are great circles, so that the areas of all cells sum to that of the sphere."""
    cells = h.all_cells(spark, res).toPandas()["cell_id"].to_numpy()
    centres = h._xyz(*np.radians(h.decode(cells)))
    total = 0.0
    for c, ring in zip(centres, h.boundary(cells), strict=True):
        a = h._xyz(np.radians(ring[:, 1]), np.radians(ring[:, 0]))
        b = np.roll(a, -1, axis=0)
        area = 2 * np.arctan2(np.cross(a, b) @ c, 1 + (a * b).sum(1) + a @ c + b @ c)
        assert (area > 0).all()
        total += area.sum()
    assert total == pytest.approx(4 * np.pi, rel=1e-9)


def test_ids_that_are_no_cells():
    assert not h.valid(np.array([0, -1, 0x85283473FFFFFFE, 0x8509_FFFF_FFFF_FFF])).any()


def test_columns(spark):
    rows = [(37.3615593, -122.0553238), (None, 1.0), (95.0, 0.0), (float("nan"), 0.0)]
    got = spark.createDataFrame(rows, "lat double, lng double").withColumn("cell", h.latlng_to_cell(F.col("lat"), F.col("lng"), 5))
    assert [r.cell for r in got.collect()] == [0x85283473FFFFFFF, None, None, None]
    wide = got.withColumn("centre", h.cell_to_latlng(F.col("cell"))).withColumn("wkt", h.cell_boundary_wkt(F.col("cell"))).collect()
    assert wide[0].wkt.startswith("POLYGON ((-12") and wide[1].wkt is None
    assert wide[0].centre.lat == pytest.approx(37.345, abs=0.02) and wide[1].centre.lat is None


def test_parents(spark):
    cell = spark.createDataFrame([("8928308280fffff",)], "x string").select(string_to_cell("x").alias("c"))
    got = cell.select(*(cell_to_string(cell_to_parent("c", r)) for r in (7, 5, 3, 1, 0)), cell_to_parent("c", 10)).first()
    assert list(got) == ["872830828ffffff", "85283083fffffff", "832830fffffffff", "81283ffffffffff", "8029fffffffffff", None]
    by_column = cell.withColumn("r", F.lit(5)).select(cell_to_string(cell_to_parent("c", F.col("r")))).first()[0]
    assert by_column == "85283083fffffff"


def test_grid_and_map(spark):
    cells = make_grid(spark, 1)
    assert cells.count() == 842 and cells.where("geometry LIKE 'MULTI%'").count() > 0
    some = cells.limit(3).select(F.col("hexid").alias("cell"), F.lit(0.5).alias("shannon"))
    joined = join_grid(cells, some)
    assert joined.count() == 3
    layer = map_layer(joined, trans="log10").collect()
    assert all(r.fill == pytest.approx(np.log10(0.5)) and r.label == "Shannon index" for r in layer)
    with pytest.raises(ValueError):
        map_layer(joined, trans="none")
    shown = in_tile(cells.select("cell_id"), (0, 0, 40, 40))
    assert 0 < shown.count() < 60 and in_tile(cells.select("cell_id"), (0, 0, 40, 40), 5).count() == 5
    box = extent(cells.select(h.cell_to_latlng(F.col("cell_id")).alias("c")).select("c.lat", "c.lng")).first()
    assert -180 <= box.xmin < box.xmax <= 180 and box.ymax < 90


def test_robinson(spark):
    from faunagrid.functions.projection import DISTANCE, LENGTH, RADIUS, robinson
    from faunagrid.operators.grid import projected_extent

    rows = [(float(lng), float(lat)) for lng in (-180, -30, 0, 180) for lat in range(-90, 91, 5)] + [(0.0, 91.0), (None, 0.0), (190.0, 0.0)]
    df = spark.createDataFrame(rows, "lng double, lat double")
    x, y = robinson(F.col("lng"), F.col("lat"))
    for r in df.select("lng", "lat", x.alias("x"), y.alias("y")).collect()[:-3]:
        at = int(abs(r.lat) // 5)
        assert r.x == pytest.approx(0.8487 * RADIUS * LENGTH[at] * np.radians(r.lng)) and r.y == pytest.approx(1.3523 * RADIUS * DISTANCE[at] * np.sign(r.lat))
    last = df.select(x.alias("x"), y.alias("y")).collect()[-3:]
    assert last[0].x is None and last[0].y is None and last[1].x is None and last[2].x == pytest.approx(0.8487 * RADIUS * np.radians(-170))
    box = projected_extent(h.all_cells(spark, 1)).first()
    assert box.ymax == pytest.approx(-box.ymin, rel=0.01) and 16_500_000 < box.xmax < 17_010_000 and 8_500_000 < box.ymax < 8_630_000


def test_datasets_are_written(spark, tmp_path):
    from faunagrid.operators import datasets
    from faunagrid.plans import registry

    source = registry._earlier(spark, "/root/testdata/sf0.001")
    paths = datasets.write_datasets(source, str(tmp_path), n=300)
    assert {*paths} == {"occ", "occ_1M", "occ_SAtlantic", "occ_fk", *(f"occ_{10 * k}s" for k in range(196, 202))}
    assert spark.read.parquet(paths["occ_1M"]).count() == 300
    assert spark.read.parquet(paths["occ_SAtlantic"]).count() == datasets.south_atlantic(source).count() > 0
    years = spark.read.parquet(paths["occ_1990s"]).agg(F.min("date_year"), F.max("date_year"), F.count("*")).first()
    assert 1990 <= years[0] <= years[1] <= 2000 and years[2] == 300
    assert datasets.write_datasets(source, str(tmp_path), n=10) == paths and spark.read.parquet(paths["occ_1M"]).count() == 10
