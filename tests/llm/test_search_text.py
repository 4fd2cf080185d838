import hashlib
import html
import random
import re
import time

import numpy as np
import pytest
from faunagrid.llm import fingerprints, html_text, pii, topk
from faunagrid.llm.registry import oracle_sql
from pyspark.sql import functions as F

from tests.oracle import assert_same, tables

SF = "/root/testdata/sf0.01"


# --- exact top-k ---


def test_topk_matches_sql(spark):
    assert_same(tables(SF), topk.op8_exact_topk(spark, SF).toPandas(), oracle_sql()["op8_exact_topk"])


def best_by_hand(rows, k=10):
    """Rows (id, whole vector), in order; each that asks, against every other row."""
    out = []
    for i, (q, v) in enumerate(rows):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), other) for j, (other, w) in enumerate(rows) if j != i)[:k]
            out += [(q, rank, other, -minus) for rank, (minus, other) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4, 2048])
def test_topk_by_hand(spark, monkeypatch, block):
    for name, value in (("BLOCK", block), ("ANNULUS", block), ("CHUNK", 3), ("FIRST", (1, 4)), ("HELD", 50)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(block)
    vectors = [[float(x) for x in rng.normal(i % 3, 1 + i % 5, 6)] for i in range(300)] + [[0.5] * 6] * 60 + [[0.0] * 6] * 2
    rows = [(i, v, "clash") for i, v in enumerate(vectors)]
    rows += [(1000, None, ""), (1001, [1.0, None, 2.0], ""), (1002, [float("nan")] * 6, ""), (1003, [float("inf")] * 6, ""), (None, vectors[0], ""), (1004, [3.0], ""), (50, vectors[50], ""), (5, vectors[50], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(df, F.col("vec_id") % 50 == 0).collect())
    valid = [(i, np.floor(1024 * np.array(v)).astype(int).tolist()) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    assert got == best_by_hand(valid)


def test_the_index_leaves_out_what_it_can(spark):
    """Vectors of 8 dimensions in clusters, of unequal norms and far from the origin: little is visited, nothing is lost."""
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 1, (200, 8))
    vectors = centres[rng.integers(0, 200, 50_000)] + rng.normal(0, 0.05, (50_000, 8)) + 0.2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(8)
    found, share = topk.searched(df, F.col("vec_id") % 500 == 0)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    whole = np.floor(1024 * vectors)
    for q in range(0, 50_000, 500):
        score = whole @ whole[q]
        score[q] = -np.inf
        best = np.argsort(-score, kind="stable")[:10]
        assert [got[q, rank] for rank in range(1, 11)] == [(int(i), int(score[i])) for i in best]
    assert share < 0.25


def test_topk_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    got = topk.search(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 1024 * 2048), (2, -1024 * 1024)]
    assert topk.search(df.where("false"), F.col("vec_id") == 0).count() == 0
    huge = spark.createDataFrame([(0, [1e30]), (1, [1e30]), (2, [-1e30])], "vec_id long, embedding array<double>")
    assert [r.score for r in topk.search(huge, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1 << 63) - 1, 1 - (1 << 63)]


# --- Lempel-Ziv fingerprints ---


def phrases_by_hand(text):
    known, at = set(), 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end] in known:
            end += 1
        known.add(text[at:end])
        at = end
    return known


def edited_by_hand(text, following):
    part = len(text) // 4
    return text[: len(text) - part] + following[:part]


def test_phrases():
    rng = random.Random(1)
    for _ in range(100):
        text = "".join(rng.choice("abcé ") for _ in range(rng.randrange(200)))
        known = set()
        found, rest = fingerprints.phrases(text, known)
        assert known == {*found} == phrases_by_hand(text) and (not rest or rest in known)
        assert "".join(found) + rest == text


def test_likeness_follows_the_sets():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    text = " ".join(rng.choices(words, k=2000))
    other = " ".join("".join(rng.choice("ijklmnop") for _ in range(6)) for _ in range(2000))
    for a, b in ((text, text), (text, other), (text, text[:6000] + other[:6000])):
        s, t = phrases_by_hand(a), phrases_by_hand(b)
        near = fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b))
        assert near == pytest.approx(len(s & t) / len(s | t), abs=0.15)


def test_fingerprints_by_hand(spark):
    rows = [(7, "the next one is not this"), (3, None), (5, "x"), (2, "abcd" * 3000), (9, "the next one is not this"), (None, "no id"), (4, "日本語のテキスト です")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string")
    got = {r.doc_id: r for r in fingerprints.with_next(df).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following, r = text or "", following or "", got[doc]
        edit = edited_by_hand(text, following)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        own, other, after = (fingerprints.fingerprint(x) for x in (text, edit, following))
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprints.written(own).hex(), fingerprints.written(other).hex())
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(own, other), fingerprints.likeness(own, after))
    assert got[7].fingerprint == got[9].fingerprint and got[3].fingerprint == ""
    assert fingerprints.with_next(df.where("false")).count() == 0
    assert fingerprints.fingerprints(df, into="f").where("doc_id = 7").first().f == got[7].fingerprint


def test_fingerprints_of_text_ids_and_of_one_id_in_all_rows(spark):
    df = spark.createDataFrame([("b", "one text"), ("a", "another text"), (None, "x"), ("c", "one text")], "doc_id string, text string")
    got = {r.doc_id: r for r in fingerprints.with_next(df).collect()}
    assert {*got} == {"a", "b", "c", None} and got["b"].near_next == 1.0 and got["a"].near_next < 1.0
    same = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 3).cast("string")).alias("text"))
    rows = fingerprints.with_next(same).collect()
    assert len(rows) == 400 and all(r.doc_id is None for r in rows)
    assert sum(r.near_next < 1 for r in rows) == 3  # equal texts stand together, so that only the last of each differs from its next


def test_long_texts_of_no_common_phrase_are_unlike():
    rng = np.random.default_rng(4)
    for n in (100, 10_000, 2_000_000):
        found = [rng.integers(0, 1 << 62, n).astype(str).tolist() for _ in range(2)]
        assert fingerprints.likeness(*(fingerprints.lowered(fingerprints.none(), x) for x in found)) <= 0.01
    for n in (1 << 30, 1 << 40):  # the smallest of n hashes, drawn at once
        a, b = ((rng.exponential(size=(4000, fingerprints.BINS)) * (1 << 57) / n).astype(np.uint64) for _ in range(2))
        assert (fingerprints.coded(a) == fingerprints.coded(b)).mean() < 0.001


def test_edited_texts_are_nearer_than_others(spark):
    got = fingerprints.op10_lz_fingerprints(spark, "/root/testdata/sf0.001").toPandas()
    assert len(got) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert (got["near_edited"] >= got["near_next"]).mean() > 0.95


# --- main text ---


def test_articles_of_the_test_pages(spark):
    got = {r.page_id: r for r in html_text.op6_html_main_text(spark, SF).collect()}
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", row.html, re.DOTALL)[1]
        parts = re.split("</?(?:p|h1)>", re.sub("</?b>", "", article.replace("<br>", " ")))
        expected = " ".join(" ".join(html.unescape(" ".join(parts)).split()).split())
        own = got.pop(row.page_id)
        assert (own.text, own.n_chars, own.url) == (expected, len(expected), row.url)
    assert not got


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1><p>The best site for long reads and more about us here</p></header>
<nav><a href=x>Home</a> <a href=y>News</a></nav><div class="cookie-notice">We use cookies to make this site better for you and all others, read on.</div>
<div id=main><h2>Storm hits the coast</h2><p>A large storm hit the coast on <a href=z>Monday</a> night,&nbsp;and many people had to leave their homes &amp; farms.<p>It was the worst in years.</p>
<!-- <p>hidden</p> --><p>Officials said that the clean-up would take weeks and that schools would stay closed until further notice.</p><form><p>Sign up here to get all the news each day</p><input></form>
<div class="related"><ul><li><a href=1>Other storm story</a><li><a href=2>More storms</a></ul></div></div><aside><p>Subscribe to our letter to get the news each day in your inbox, for free.</p></aside>
<div id="comments"><p>Great article! I have been there myself and saw all of it with my eyes.</p></div><footer>(c) 2024 Site Inc. All rights reserved.</footer></body></html>"""


def test_a_page_without_article():
    text = html_text.main_text(PAGE)
    assert text.startswith("Storm hits the coast A large storm") and "homes & farms. It was" in text and text.endswith("until further notice.")


WORDS = "A storm hit the coast on Monday night and many people had to leave their homes and farms for some days".split()
P = " ".join(WORDS) + "."
NAV = '<ul class="menu"><li><a href=/a>Home</a></li><li><a href=/b>News</a></li><li><a href=/c>Sport</a></li></ul>'
END = '<div id="footer"><p>Copyright 2024 by the site, all rights reserved.</p></div>'


@pytest.mark.parametrize(
    ("before", "behind"),
    [
        ("<div class='layout with-sidebar'><article>", "</article></div>"),
        ("<div class='no-sidebar'><article>", "</article></div>"),
        ("<article><section id='search-history'>", "</section></article>"),
        ("<div class='sidebar-layout'><main>", "</main><div class='sidebar'><p>Sign up for our letter and get the news each day.</p></div></div>"),
        ("<form id=page action=x><div class=content>", "</div></form>"),
        ("<div class='post'><div class='entry-content'>", "</div><div class='comments-area'><p>Great text! I was there too and saw all of it myself.</p></div></div>"),
        ("<article><svg viewBox='0 0 1 1'><path d='M0'>", "</article>"),
        ("<article><button>Menu", "</article>"),
        ("<article><svg class=x />", "<aside><p>Read our other texts on storms of the last years.</p></aside></article>"),
        ("<table><tr><td>", "</table>"),
        ("<article><div class=newsletter><p>Sign up for our letter and get the news each day.</p></div>", "<div class=share><p>Tell your friends of this text</p></div></article>"),
        ("<main><noscript><img src=x>Turn on scripts</noscript><select><option>One<option>Two</select>", "</main>"),
        ("<div class=wrap><div class=siteHeader><p>The best site of all</p></div><div class=body>", "</div></div>"),
    ],
)
def test_other_templates(before, behind):
    page = f"<html><head><title>T<b></title><body>{NAV}{before}<h1>The storm of the year</h1><p>{P}<p>{P} x &lt; y</p><p>{P}</p>{behind}{END}"
    assert html_text.main_text(page) == f"The storm of the year {P} {P} x < y {P}"


def test_pages_without_optional_tags():
    assert html_text.main_text(f"<title>T</title><style>p{{}}</style><article><h1>Title</h1><p>{P}</article>") == f"Title {P}"
    assert html_text.main_text(f"<head><meta charset=utf-8><article><p>{P} <math><mi>x</mi></math> is</article>") == f"{P} x is"
    assert html_text.main_text(f"<article><p title='a > b' class=\"x\">{P}<br/>and<!-- - > no --> more</p ></article>") == f"{P} and more"


@pytest.mark.parametrize("part", ["<a x", "<p title=\"", "<p title='", "<", "</", "<!", "<!--", "<div>", "</x>", "<div></p>", "<svg>", "<p a=b ", "&lt", "<p " + " " * 20, "<script>", "<ul><li class=nav>x", "<a href=x>y", "=\"'"])
def test_time_is_linear(part):
    for start in ("", "<article><p>text ", "<div>" * 2000):
        page = start + part * (300_000 // len(part))
        began = time.perf_counter()
        html_text.main_text(page)
        assert time.perf_counter() - began < 5


def test_the_tree_learns_its_table():
    data = np.array([line.split() for line in html_text.LABELLED.strip().splitlines()], float)
    assert data.shape[1] == len(html_text.FEATURES) + 1
    assert (html_text.judge(html_text.tree(), data[:, :-1]) == data[:, -1]).all()


def test_page_edges(spark):
    rows = [(1, None), (2, ""), (3, "<p>"), (4, "<article><p>" + "word " * 50_000), (5, "<script>never closed <p>x"), (6, "a < b && c > d <!-- x"), (6, "<article><p>&#xE9;t&eacute; &zzz; &amp;lt;</p></article>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.html is None or len(r.html) < 5] == ["", "", ""]
    assert {"été &zzz; &lt;"} <= {r.text for r in got}
    assert html_text.extract(df.where("false")).count() == 0


# --- surrogates ---

KEY = b"of the tests"
TEXT = "Mail Ann.Lee@mail1.example.com or call +1 (344) 555-8704, card 4111 1111 1111 1111, from 72.232.91.159; Mr. John Smith met Anna Müller, Иван Петров and Dr Smith. DE89 3704 0044 0532 0130 00, 123-45-6789."
SECRETS = ["Ann.Lee", "555-8704", "4111 1111 1111 1111", "72.232.91.159", "John", "Smith", "Anna", "Müller", "Иван", "Петров", "3704", "123-45-6789"]


def test_surrogates_keep_type_and_format():
    out, n = pii.replaced(TEXT, {}, KEY)
    assert n == len(pii.entities(TEXT)) == 13
    assert not any(x in out for x in SECRETS)
    assert [k for _, _, k, _ in pii.entities(out)] == [k for _, _, k, _ in pii.entities(TEXT)] or "met" in out
    card = re.search(r"card (\d{4} \d{4} \d{4} \d{4})", out)[1]
    assert pii.luhn(card.replace(" ", "")) == 0
    iban = re.search(r"DE\d\d[\d ]+", out)[0].replace(" ", "")[:22]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    first, last = re.search(r"Mr\. (\w+) (\w+) met", out).groups()
    assert first in pii.GIVEN["latin", "m"] and f"Dr {last}" in out
    assert re.search(r"met (\w+)", out)[1] in pii.GIVEN["latin", "f"] and re.search(r", ([А-я]+) ", out)[1] in pii.GIVEN["cyrillic", "m"]
    assert pii.replaced(TEXT, {}, KEY) == (out, n) and pii.replaced(TEXT, {}, b"another key")[0] != out


def test_clean_texts_stay():
    for text in ("", "Nothing private is here. Call me at 5, or in 2024.", "Version 1.2.3.4.5 and 1,234,567.89", "John", "De De De"):
        assert pii.replaced(text, {}, KEY) == (text, 0)


def test_all_mentions_of_a_name():
    text = "Mr. John Smith met Contact Priya Patel. Later Smith left; PRIYA's letter to Patel and Smith's answer were lost. A smith works. Dear Customer Service"
    out, n = pii.replaced(text, {}, KEY)
    assert n == 8 and not any(x in out for x in ("John", "Smith", "Priya", "PRIYA", "Patel")) and "A smith works" in out and "Customer Service" in out
    smith, patel = re.search(r"Mr\. \w+ (\w+) met", out)[1], re.search(r"Contact \w+ (\w+)\.", out)[1]
    assert f"Later {smith} left" in out and f"{smith}'s answer" in out and f"to {patel} and" in out


def test_only_valid_cards():
    assert [k for *_, k, _ in pii.entities("4111 1111 1111 1111 and 4111 1111 1111 1112")] == ["card"]


@pytest.mark.parametrize("part", ["a", "a.", "@", "a@", "@a.", "1", "1-", "+1 ", "Mary ", "Mr ", "Dear A", "DE12 ", "a-", "Mary a-"])
def test_detection_is_linear(part):
    text = part * (200_000 // len(part))
    began = time.perf_counter()
    pii.entities(text), pii.entities(text + "@"), pii.entities("Mary Smith " + text)
    assert time.perf_counter() - began < 10


def attempts_by_hand(found, key):
    """Attempts of all entities (kind, entity), round by round."""
    attempts = dict.fromkeys(found, 0)
    while True:
        family = lambda kind: kind.partition(":")[0]
        made = {x: (family(x[0]), pii.surrogate(*x, n, key)) for x, n in attempts.items()}
        owner = {}
        for x, m in made.items():
            owner[m] = min(owner.get(m, x[1]), x[1])
        real = {(family(k), e) for k, e in attempts}
        clash = [x for x, m in made.items() if owner[m] != x[1] or m in real and family(x[0]) != "given"]
        if not clash:
            return attempts
        for x in clash:
            attempts[x] += 1


def hold_by_hand(got, docs):
    """Texts by id against detection and rounds in plain Python; returns the largest attempt."""
    found = {doc: pii.entities(text or "") for doc, text in docs.items()}
    attempts = attempts_by_hand({(k, pii.normal(k, s)) for x in found.values() for *_, k, s in x}, KEY)
    assert {*got} == {*docs}
    surrogates = {}
    for doc, text in docs.items():
        out, at = "", 0
        for start, end, kind, surface in found[doc]:
            own = kind, pii.normal(kind, surface)
            new = pii.surrogate(*own, attempts[own], KEY)
            surrogates.setdefault((kind, new), set()).add(own)
            out += text[at:start] + pii.formatted(kind, surface, new)
            at = end
        assert got[doc] == (len(found[doc]), None if text is None else out + text[at:])
    assert all(len(x) == 1 for x in surrogates.values())  # none shared
    return max(attempts.values())


def test_query_of_surrogates_by_hand(spark):
    spark.conf.set(pii.KEY_SETTING, KEY.decode())
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: (r.n_entities, r.text) for r in pii.op5_pii_surrogates(spark, sf).collect()}
    spark.conf.unset(pii.KEY_SETTING)
    hold_by_hand(got, {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()})


def test_crowded_forms(spark):
    """Nearly all one-letter addresses of a domain are entities, so that attempts go on until forms are wider."""
    docs = dict(enumerate(f"{c}@m{j}.io or {c.upper()}@M{j}.IO, and Mr {c.upper()}ex Lo of {j}.0.0.{ord(c)}" for c in "abcdefghijklmnopqrstuvwxy" for j in range(3)))
    docs |= {1000: None, 1001: "", 1002: docs[0]}
    df = spark.createDataFrame([(k, x, "clash") for k, x in docs.items()], "doc_id long, text string, n_entities string")
    got = {r.doc_id: (r.n_entities, r.text) for r in pii.pseudonymise(df, KEY).collect()}
    assert hold_by_hand(got, docs) >= pii.WIDER
    assert pii.pseudonymise(df.where("false"), KEY).count() == 0


def test_keys_come_from_outside(spark):
    assert pii.key_of(spark) != pii.key_of(spark)
    spark.conf.set(pii.KEY_SETTING, "mine")
    assert pii.key_of(spark) == b"mine"
    spark.conf.unset(pii.KEY_SETTING)
