"""Secret scans with multipart credential linking, by DataFrame functions alone.

Base kinds are reported wherever they stand. Weak kinds (an account name, an opaque string, an
endpoint) are reported only when a complementary part stands within ``scope`` code points:
an identifier (access key or account) with a secret (assignment, hex or opaque string), and an
endpoint with either. The link is an interval join by a sweep: the parts of a document and role, in
the order of their starts, carry the largest end so far, and a weak candidate asks for it where
its scope ends. So it looks from the nearer ends of both spans, and however many parts share a
scope, each is sorted once and no pairs are made.

Offsets are code points, ends exclusive. Defined cases: a null text counts as empty and has no
spans; rows with a null id are scanned like others; repeated rows (same id and text) have the
same spans; a document of any length is scanned whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faunagrid.llm.storage import stored, table

SCOPE = 300


def either_case(word: str) -> str:
    """A pattern for the word with letters in either case, the same in every regex dialect."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


def _assigned(words: tuple[str, ...], value: str) -> str:
    return f"({'|'.join(map(either_case, words))})[\"']?\\x20*[:=]\\x20*[\"']?({value})"


#: Pattern and test of a match ``m`` (SQL, group 2 of assignments as ``v``), by kind, in the order of kinds.
BASE = {
    "assign": (_assigned(("password", "passwd", "secret", "token", "api_?key"), "[A-Za-z0-9+/_.=-]+"), "length(v) >= 6"),
    "access": ("AKIA[A-Z0-9]+", "length(m) >= 20"),
    "hex": ("[0-9a-f]{24,}", "length(m) >= 24"),  # a run is matched whole, so shorter ones need no match
}
WEAK = {
    "account": (_assigned(("username", "user", "login", "account", "client_id", "access_key_id"), "[A-Za-z0-9_.@+-]+"), "length(v) >= 3"),
    "opaque": ("[A-Za-z0-9+/]{40,}", "length(m) = 40 AND regexp_like(m, '[0-9]') AND regexp_like(m, '[A-Z]') AND regexp_like(m, '[a-z]')"),
    "endpoint": ("https?://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+|[a-z0-9.-]+[.]amazonaws[.]com|[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}", "length(m) >= 7"),
}
KINDS = [*BASE, *WEAK]
ROLE = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "identifier", "account": "identifier", "endpoint": "endpoint"}
#: The roles that make a weak part of a role worth reporting.
PARTNERS = {"secret": ["identifier"], "identifier": ["secret"], "endpoint": ["identifier", "secret"]}

SPAN = "struct<start:int,ord:int,kind:string,end:int>"


def running(lengths: Column) -> Column:
    """Sums of an array up to each of its places, by doubling: n log n steps, where appending one by one copies n * n."""

    def doubled(sums: Column, k: Column) -> Column:
        by = F.call_function("shiftleft", F.lit(1), k)
        return F.zip_with(sums, F.concat(F.array_repeat(F.lit(0), by), F.slice(sums, F.lit(1), F.size(sums) - by)), lambda x, y: x + y)

    rounds = F.ceil(F.log2(F.size(lengths))).cast("int")
    return F.when(F.size(lengths) > 1, F.aggregate(F.sequence(F.lit(0), rounds - 1), lengths, doubled)).otherwise(lengths)


def spans_of(text: Column, kind: str) -> Column:
    """Spans of one kind, leftmost and non-overlapping: array of (start, ord, kind, end)."""
    pattern, test = (BASE | WEAK)[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))  # what stands before each match
    ends = running(F.zip_with(gaps, matches, lambda gap, m: F.char_length(gap) + F.char_length(m)))
    found = F.filter(F.zip_with(ends, matches, lambda end, m: F.struct(end.alias("end"), m.alias("m"))), lambda x: _passes(x["m"], pattern, test))
    spans = F.transform(found, lambda x: F.struct((x["end"] - F.char_length(x["m"])).alias("start"), F.lit(KINDS.index(kind)).alias("ord"), F.lit(kind).alias("kind"), x["end"]))
    return F.coalesce(F.when(text.rlike(pattern), spans), F.array().cast(f"array<{SPAN}>"))


def _passes(m: Column, pattern: str, test: str) -> Column:
    """The test of a kind as a column; tests are conjunctions of the few forms above."""
    out = F.lit(True)
    for term in test.split(" AND "):
        if term.startswith("regexp_like"):
            out &= m.rlike(term.split("'")[1])
            continue
        what, relation, n = term.split()
        length = F.char_length(F.regexp_extract(m, pattern, 2) if "v" in what else m)
        out &= length == int(n) if relation == "=" else length >= int(n)
    return out


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """For each row of ``df``: key, ``base`` and ``linked`` (arrays of spans)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = df.select(F.col(key).alias("id"), F.xxhash64(whole).alias("body"), F.concat(*(spans_of(whole, k) for k in BASE)).alias("base"), F.concat(*(spans_of(whole, k) for k in WEAK)).alias("weak"))
    found = stored(found, "spans")
    candidates = found.where(F.size("weak") > 0).dropDuplicates(["id", "body"])
    role = F.element_at(F.create_map(*(F.lit(x) for pair in ROLE.items() for x in pair)), F.col("part.kind"))
    partners = F.element_at(F.create_map(*(x for r, p in PARTNERS.items() for x in (F.lit(r), F.array(*map(F.lit, p))))), role)
    nothing = F.lit(None)
    held = candidates.select("id", "body", F.explode(F.concat("base", "weak")).alias("part"))
    held = held.select("id", "body", role.alias("role"), F.col("part.start").alias("at"), F.lit(False).alias("asks"), F.col("part.end").alias("end"), nothing.cast(SPAN).alias("part"))
    weak = candidates.select("id", "body", F.explode("weak").alias("part"))
    weak = weak.select("id", "body", F.explode(partners).alias("role"), (F.col("part.end") + scope).alias("at"), F.lit(True).alias("asks"), nothing.cast("int").alias("end"), "part")
    before = Window.partitionBy("id", "body", "role").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = held.unionByName(weak).withColumn("reach", F.max("end").over(before))
    linked = swept.where(F.col("asks") & (F.col("reach") >= F.col("part.start") - scope)).groupBy("id", "body").agg(F.array_sort(F.collect_set("part")).alias("linked"))
    back = F.col("f.id").eqNullSafe(F.col("l.id")) & (F.col("f.body") == F.col("l.body"))
    return found.alias("f").join(linked.alias("l"), back, "left").select(F.col("f.id").alias(key), "base", F.coalesce("linked", F.array().cast(f"array<{SPAN}>")).alias("linked"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    counts = [_count(kind).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.concat("base", "linked")).alias("spans"))


#: Kind, place among kinds, role, whether weak, pattern and test of a match: written out for DuckDB, apart from the patterns above.
_SQL_KINDS = (
    ("assign", 0, "secret", False, """([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([-A-Za-z0-9+/_.=]+)""", "length(g2) >= 6"),
    ("access", 1, "identifier", False, "AKIA[0-9A-Z]+", "length(m) >= 20"),
    ("hex", 2, "secret", False, "[a-f0-9]+", "length(m) >= 24"),
    ("account", 3, "identifier", True, """([uU][sS][eE][rR][nN][aA][mM][eE]|[uU][sS][eE][rR]|[lL][oO][gG][iI][nN]|[aA][cC][cC][oO][uU][nN][tT]|[cC][lL][iI][eE][nN][tT]_[iI][dD]|[aA][cC][cC][eE][sS][sS]_[kK][eE][yY]_[iI][dD])["']? *[:=] *["']?([-A-Za-z0-9_.@+]+)""", "length(g2) >= 3"),
    ("opaque", 4, "secret", True, "[+/0-9A-Za-z]+", "length(m) = 40 AND m SIMILAR TO '.*[0-9].*' AND m <> lower(m) AND m <> upper(m)"),
    ("endpoint", 5, "endpoint", True, r"https?://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+|[-.a-z0-9]+\.amazonaws\.com|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}", "length(m) >= 7"),
)


def _kind_sql(kind: str, ord: int, role: str, weak: bool, pattern: str, test: str) -> str:
    quoted = pattern.replace("'", "''")
    group = f", regexp_extract(m, '{quoted}', 2) AS g2" if "g2" in test else ""
    return f"""
SELECT doc_id, '{kind}' AS kind, {ord} AS ord, '{role}' AS role, {str(weak).lower()} AS weak,
       CAST(upto - length(m) AS BIGINT) AS start, CAST(upto AS BIGINT) AS stop
FROM (
    SELECT doc_id, m{group}, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto
    FROM (
        SELECT doc_id, unnest(regexp_extract_all(text, '{quoted}', 0)) AS m, unnest(list_slice(gaps, 1, -2)) AS gap,
               unnest(range(1, len(gaps))) AS pos
        FROM (SELECT doc_id, text, string_split_regex(text, '{quoted}') AS gaps FROM docs WHERE regexp_matches(text, '{quoted}'))
    )
)
WHERE {test}"""


_LISTED = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord)"

OP9_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({" UNION ALL ".join(_kind_sql(*x) for x in _SQL_KINDS)}),
partners AS (SELECT * FROM (VALUES ('secret', 'identifier'), ('identifier', 'secret'), ('endpoint', 'identifier'), ('endpoint', 'secret')) AS p(role, partner)),
kept AS (
    SELECT * FROM parts WHERE NOT weak
    UNION
    SELECT a.* FROM parts a JOIN partners p ON a.role = p.role
    JOIN parts b ON a.doc_id = b.doc_id AND b.role = p.partner AND a.start - b.stop <= 300 AND b.start - a.stop <= 300
    WHERE a.weak
)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
       sha256({_LISTED} FILTER (NOT weak), '')) AS base_sha256,
       {_LISTED} FILTER (kind IS NOT NULL), '') AS spans
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id GROUP BY d.doc_id
"""
