import random
import re

import corpus_pipeline
import pytest
from faunagrid.llm import bpe, mixing, quality

from tests.llm.test_lines_secrets import by_hand as lines_by_hand
from tests.llm.test_near import by_hand as near_by_hand

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before each stage, and the last stage's rows."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out.append(docs)
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns(steps):
    assert all(x.columns == steps[0].columns for x in steps[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_copies", "source_mix", "tokens"]


def test_quality_stage(spark, steps):
    model = quality.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in quality.score(steps[0], model).where(f"score >= {quality.THRESHOLD}").collect()}
    assert pairs(steps[1]) == [x for x in pairs(steps[0]) if x[0] in kept]


def test_line_stage(steps):
    assert pairs(steps[2]) == sorted((doc, text) for doc, _, _, text in lines_by_hand(pairs(steps[1])))
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near_stage(steps):
    rows = pairs(steps[2])
    groups = near_by_hand(rows)
    assert pairs(steps[3]) == [x for x in rows if groups[x[0]][1] == x[0]]


def test_mix_stage(steps):
    rows = pairs(steps[3])
    times = {r.doc_id: r.taken // r["size"] if r["size"] else 0 for r in mixing.mix(steps[3]).collect()}
    assert pairs(steps[4]) == sorted(x for x in rows for _ in range(times[x[0]]))
    words = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text))
    total = sum(words(t) for _, t in rows)
    assert abs(sum(words(t) for _, t in pairs(steps[4])) - 1.5 * total) <= 0.05 * total


def test_mix_stage_with_null_and_repeated_ids(spark):
    source = lambda i: "abc"[i % 3]
    rows = [(None if i % 3 == 1 else 7 if i % 5 == 0 else i, f"w{i} " * (1 + i % 23), "en", source(i), 0) for i in range(900)]
    docs = spark.createDataFrame([*rows, (7, "", "en", "a", 0), (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in corpus_pipeline.mix_sources(spark, docs, SF).collect()]
    assert set(got) <= set(rows) and max(got.count(r) for r in set(got)) <= 2
    assert any(r[0] is None for r in got) and any(r[0] == 7 for r in got)
    targets = {r.source: r.target for r in mixing.mix(docs, key="source").select("source", "target").distinct().collect()}
    for name in "abc":
        assert abs(sum(len(r[1].split()) for r in got if r[3] == name) - targets[name]) <= 1


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, taken string, id string, size string, n_lines string"


def odd_documents(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, copies, and columns named like those of the operators."""
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    extra = ("s", "t", "i", "z", "l")
    rows = [(i, f"{words(30)}\nthe same line in all of the documents", "en", "ab"[i % 2], 0, *extra) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " more", "en", None, None, *extra) for i in range(10)]  # near copies
    rows += [rows[3], rows[3], (None, rows[4][1], None, None, None, *extra), (None, None, *[None] * 8), (200, None, *[None] * 8), (201, "", "en", "a", 0, *extra), (202, words(20_000), "en", "a", 0, *extra)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("few", [False, True])
def test_stages_take_odd_documents(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(quality, "THRESHOLD", 0.0)  # those are junk to the model
    docs = odd_documents(spark)
    docs = docs.where("false") if few else docs
    rows, out = docs.collect(), {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert name == "tokens" or dict(found.dtypes) == dict(docs.dtypes) and found.columns == docs.columns
        found.write.parquet(str(tmp_path / name))
        out[name] = docs = spark.read.parquet(str(tmp_path / name))
    if few:
        assert [x.count() for x in out.values()] == [0] * 5
        return
    key = lambda r: tuple(map(str, r))
    assert sorted(out["quality"].collect(), key=key) == sorted(rows, key=key)
    got = sorted(((r.doc_id, r.text, r.score, r.n_lines) for r in out["line_dedup"].collect()), key=str)
    expected = zip(rows, lines_by_hand([(r.doc_id, r.text) for r in rows]), strict=True)
    assert got == sorted(((doc, text, r.score, r.n_lines) for r, (doc, _, _, text) in expected), key=str)
    before, kept = out["line_dedup"].collect(), out["near_copies"].collect()
    groups = near_by_hand(sorted({(r.doc_id, r.text) for r in before if r.doc_id is not None}))
    assert {r.doc_id for r in kept if r.doc_id is not None} == {doc for doc, (_, group) in groups.items() if doc == group}
    assert [r.doc_id for r in kept].count(3) == 1 and [r.doc_id for r in kept].count(None) == 2
    mixed = out["source_mix"].collect()
    assert {key(r) for r in mixed} <= {key(r) for r in kept} and all(r.text for r in mixed)
    assert out["tokens"].count() == len(mixed)


def test_token_stage_and_run(spark, steps):
    codec = bpe.Codec(bpe.read_ranks(bpe.vocabulary()[0]), bpe.vocabulary()[1])
    expected = sorted((doc, len(codec.encode(text or ""))) for doc, text in pairs(steps[4]))
    assert sorted((r.doc_id, r.n_tokens) for r in steps[5].collect()) == expected
    assert sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()) == expected
