import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from faunagrid.llm import mixing, quality
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    got = quality.op2_quality_classifier(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    both = got.merge(labels, on="doc_id")
    held = both[both["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.9
    assert (held[held["quality"] == 1]["predicted"] == 1).mean() > 0.97


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (1, "", 0.1), (None, "x " * 40000, 0.2)], "doc_id long, text string, score double")
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, empty)).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, ones)).collect()} <= {1.0, 0.5}
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    got = quality.score(docs, model).collect()
    assert all(0 <= r.score <= 1 for r in got) and quality.score(docs.where("false"), model).count() == 0


def test_scores_by_hand(spark):
    """Every score of the query, from sizes compressed here one piece at a time."""
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in quality.op2_quality_classifier(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert len(model.good) > 1000 and len(model.bad) > 1000 and model.weights[1] < 0
    sides = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(x), write_content_size=False, write_checksum=False, write_dict_id=False) for x in (model.good, model.bad)]
    for r in docs.collect():
        data = (r.text or "").encode()
        sizes = [sum(len(side.compress(data[i : i + 1024])) for i in range(0, max(1, len(data)), 1024)) for side in sides]
        n = max(1, len(data))
        x = [1.0, min(8.0, max(-8.0, 20 * (sizes[0] - sizes[1]) / n)), min(15.0, 10 * min(sizes) / n)]
        score = 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.weights, strict=True))))
        held, own, predicted = got[r.doc_id]
        assert own == pytest.approx(score, abs=1e-9) and predicted == int(own >= 0.3) and held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert len(got) == docs.count()


def test_no_held_out_label_is_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, labels) == quality.fit(docs, other)


def test_quality_learns_from_whole_texts(spark):
    rng = random.Random(8)
    words = lambda letters, n: " ".join("".join(rng.choices(letters, k=5)) for _ in range(n))
    start = words("abcdefg", 4000)
    rows = [(i, start + words("hijklmn" if i % 2 else "opqrstu", 6000)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs, docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality"))
    found = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert min(x for i, x in found.items() if i % 2) > 0.5 > max(x for i, x in found.items() if not i % 2)


def best_sum(sizes, counts, budget):
    sums = {0}
    for s, c in zip(sizes, counts, strict=True):
        sums = {x + s * k for x in sums for k in range(c + 1) if x + s * k <= budget}
    return max(sums)


def test_fill_is_the_best_subset_sum():
    rng = random.Random(5)
    for _ in range(200):
        sizes = rng.sample(range(1, 40), rng.randrange(1, 6))
        counts = [rng.randrange(4) for _ in sizes]
        budget = rng.randrange(120)
        taken = mixing.fill(np.array(sizes), np.array(counts), budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        assert int((taken * sizes).sum()) == best_sum(sizes, counts, budget)


def test_fit_keeps_its_bounds():
    rng = np.random.default_rng(2)
    for _ in range(200):
        sizes = rng.choice(np.arange(300), rng.integers(1, 30), replace=False)
        counts = rng.integers(1, 50, len(sizes))
        total = int((sizes * counts).sum())
        target = rng.uniform(0, 2) * total
        taken = mixing.fit(sizes, counts, target)
        assert (taken >= 0).all() and (taken <= 2 * counts).all()
        assert (taken * sizes).sum() <= round(target)
        if len(sizes) > 8:
            assert target - (taken * sizes).sum() <= sizes.max()


def test_fit_of_few_very_long_documents():
    for sizes, target in (([200_000, 150_000, 100_000], 700_000), ([100_000, 101_000, 102_000, 103_000], 609_000), ([100_000, 60_000, 10_000], 120_000)):
        counts = [1 + (s == 60_000) for s in sizes]
        total = sum(s * c for s, c in zip(sizes, counts, strict=True))
        got = int((mixing.fit(np.array(sizes), np.array(counts), target) * sizes).sum())
        whole = target // total * total
        assert got == target == whole + best_sum(sizes, counts, target - whole)
    rng = random.Random(6)
    for _ in range(50):
        sizes = rng.sample(range(70_000, 3_000_000), rng.randrange(1, 8))
        counts = [rng.randrange(1, 3) for _ in sizes]
        goal = rng.randrange(sum(s * c for s, c in zip(sizes, counts, strict=True)))
        got = int((mixing.fit(np.array(sizes), np.array(counts), goal) * sizes).sum())
        best = best_sum(sizes, counts, goal)
        assert got == best if goal <= 8 * max(sizes) else got <= best


def water(sizes, weights, budget):
    """Targets by resharing the excess until none is above."""
    target, open_ = dict.fromkeys(sizes, 0.0), {k for k, s in sizes.items()}
    left = budget
    while open_ and left > 1e-9:
        share = left / sum(weights[k] for k in open_)
        full = {k for k in open_ if share * weights[k] >= 2 * sizes[k]}
        if not full:
            for k in open_:
                target[k] = share * weights[k]
            break
        for k in full:
            target[k] = 2.0 * sizes[k]
            left -= target[k]
        open_ -= full
    return target


def test_targets(spark):
    rng = random.Random(4)
    for n in (1, 2, 7, 20):
        names = [*(f"s{i:02d}" for i in range(n - 1)), None]
        sizes = {k: rng.choice([0, 5, 100, 10_000]) for k in names}
        weights = dict(zip(names, itertools.cycle((5, 2, 1))))
        df = spark.createDataFrame([*sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == pytest.approx(water(sizes, weights, 1.5 * sum(sizes.values())), rel=1e-9)


def test_mix_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.op3_source_mix(spark, SF).toPandas()
    texts = docs.toPandas().set_index("doc_id")
    words = texts["text"].fillna("").map(lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x)))
    assert got.set_index("doc_id")["size"].to_dict() == words.to_dict()
    assert got["taken"].le(2 * got["size"]).all() and (got["taken"] % got["size"].clip(lower=1) == 0).all()
    by = got.assign(source=got["doc_id"].map(texts["source"])).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), own=("source_size", "first"))
    assert (by["size"] == by["own"]).all() and ((by["taken"] - by["target"]).abs() <= 1).all()
    again = mixing.op3_source_mix(spark, SF).toPandas()
    assert (got.sort_values("doc_id")["taken"].to_numpy() == again.sort_values("doc_id")["taken"].to_numpy()).all()


def test_mix_edges(spark):
    rows = [(1, None, None), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "z", None), (5, "w " * 50_000, "b")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))).collect()
    assert len(got) == len(rows) and all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same three words").alias("text"), F.when(F.col("id") % 3 > 0, "hot").alias("source"))
    total = mixing.mix(many).groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.target - r.t) <= 3 for r in total)
