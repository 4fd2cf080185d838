import pytest
from faunagrid.operators import datasets
from faunagrid.sources import occurrences as occ
from pyspark.sql import functions as F

FLAT = "decimallongitude double, DecimalLatitude double, species string, AphiaID long, records double, Dropped boolean, absence boolean"
ROWS = [
    (1.0, 2.0, "x", 7, 2.5, None, False),
    (1.0, 2.0, "x", 7, 3.5, True, False),
    (1.0, 2.0, None, 7, 1.0, False, None),
    (None, 2.0, "x", 7, 1.0, False, None),
    (5.0, 2.0, "y", None, 1.0, False, True),
]


def test_names_in_any_case_and_rounding(spark):
    got = occ.normalise(spark.createDataFrame(ROWS, FLAT))
    assert {"aphiaid", "order", "date_year", "dropped", "absence"} <= {*got.columns}
    assert sorted(r.records for r in got.collect()) == [1, 1, 1, 2, 4]
    assert [r.records for r in occ.cleaned(got).collect()] == [2]


def test_nested_source(spark):
    flat = spark.createDataFrame(ROWS, FLAT)
    nested = flat.select(F.struct(*(c for c in flat.columns if c not in ("Dropped", "absence"))).alias("interpreted"), "Dropped", "absence")
    assert occ.cleaned(occ.normalise(nested)).collect() == occ.cleaned(occ.normalise(flat)).collect()


def test_flags_may_be_missing(spark):
    assert occ.cleaned(occ.normalise(spark.createDataFrame(ROWS, FLAT).drop("Dropped", "absence"))).count() == 3


def test_missing_required_column(spark):
    with pytest.raises(ValueError, match="species"):
        occ.normalise(spark.createDataFrame([(1.0, 2.0)], "decimalLongitude double, decimalLatitude double"))


def test_box(spark):
    df = occ.normalise(spark.createDataFrame(ROWS, FLAT))
    assert occ.within(df, (1, 2, 5, 2)).count() == 4
    with pytest.raises(ValueError, match="four"):
        occ.within(df, (1, 2, 3))


def test_read_several_paths_and_schema(spark, tmp_path):
    df = spark.createDataFrame(ROWS, FLAT)
    df.write.parquet(str(tmp_path / "a"))
    df.write.parquet(str(tmp_path / "b"))
    assert occ.read(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 10
    assert occ.read(spark, str(tmp_path / "*")).schema == df.schema
    assert occ.local_or_remote(str(tmp_path), "s3a://far/*") and occ.local_or_remote(str(tmp_path / "no"), "s3a://far/*", True) == ["s3a://far/*"]
    assert occ.local_or_remote(str(tmp_path / "no"), "s3a://far/*") == []


def test_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, FLAT).write.parquet(str(tmp_path / "a"))
    plan = occ.cleaned(occ.normalise(occ.read(spark, str(tmp_path / "a"))))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(" in plan


def test_samples(spark):
    df = spark.range(1000).withColumn("species", F.lit("x"))
    a, b = (sorted(r.id for r in datasets.sample_exactly(df, 100).collect()) for _ in range(2))
    assert len(a) == 100 and a == b
    assert a != sorted(r.id for r in datasets.sample_exactly(df, 100, seed=1).collect())
    assert datasets.sample_exactly(df, 5000).count() == 1000


def test_decades_share_their_border(spark):
    df = spark.createDataFrame([(1.0, 1.0, "x", y) for y in (1969, 1970, 1970, 1980)], "decimalLongitude double, decimalLatitude double, species string, date_year int")
    assert {r.date_year: r.records for r in datasets.decade(df, "1960s").collect()} == {1969: 1, 1970: 2}
    assert {r.date_year for r in datasets.decade(df, "1970s").collect()} == {1970, 1980}
