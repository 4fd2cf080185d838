"""PII: surrogates for personal data.

Detected entities (e-mail addresses, phone and card numbers, IP addresses, IBANs, social
security numbers, and names of people) are replaced by keyed surrogates of the same type and
format: letters by letters of the same script and case, digits by digits, check digits that
hold where they held, given names by others of the same gender and script. A surrogate depends
only on the key, the entity and an attempt number, so that mentions of one entity agree in all
documents. All distinct entities are checked together: where two would share a surrogate, or a
surrogate is itself an entity of the corpus, all but the smallest try again, until none collide;
with the attempts the forms to draw from become more, so that they end.

Names are found by a title, a listed given name or a word of address before them; then every
other mention of such a name in the same document is one too. There is no list of all names: one that
a document only ever mentions alone is not found. Numbers of 13 to 19 digits are cards if their check digit holds.

Defined cases: a null text stays null; entities are compared in normalised form (letter case,
spaces and punctuation aside); repeated rows are replaced alike; output columns replace input
columns of the same names; rows with a null id are treated like others; texts of any length
are read in time linear in it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunagrid.llm.storage import arrow_map, dropped, stored, table

#: The setting that holds the key. Whoever has the key can tell which entity a surrogate stands for; without it a run draws its own.
KEY_SETTING = "spark.faunagrid.surrogates.key"
#: Attempts after which there are more forms to draw from.
WIDER = 6

#: Given names by script and gender.
GIVEN = {
    ("latin", "f"): "Alice Anna Barbara Carla Claudia Clara Diana Elena Emily Emma Eva Hannah Helen Isabel Jane Julia Karen Laura Linda Lucia Maria Mary Nancy Nina Olivia Paula Rachel Rosa Sandra Sarah Sofia Susan Teresa Ursula Vera".split(),
    ("latin", "m"): "Albert Anton Bernard Carlos Charles Daniel David Diego Edward Eric Felix Frank George Hans Henry Hugo James John Jorge Joseph Karl Kevin Louis Luis Mark Martin Michael Oscar Paul Peter Robert Simon Stefan Thomas Victor William".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Светлана".split(),
    ("cyrillic", "m"): "Алексей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
    ("greek", "f"): "Αννα Ελένη Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Señor Señora Monsieur Madame".split()
#: Words of address before a given name and a family name, and words after them that are no names.
ADDRESS = "Dear Hello Hi Contact Attn Regards Sincerely Signed Name From To Patient Customer Employee".split()
NO_NAMES = frozenset("Sir Madam Customer Service Support Team Sales Us All Everyone Friend Friends Colleague Colleagues Help Desk Office The Our Your This".split())
SYLLABLES = {
    "latin": "ba be bi bo da de do fa fe ga go ha he ka ke ko la le li lo ma me mi mo na ne no pa pe ra re ro sa se so ta te to va ve wa we za".split(),
    "cyrillic": "ба бе бо ва ве га го да де жа за ка ко ла ле ма ми мо на не по ра ре ро са се та то ша".split(),
    "greek": "βα γα δε θα κα κο λα λε μα με νι πα πο ρα σα σε τα τε φα χα".split(),
}
ENDINGS = {"latin": "ck n rd s ster tz".split(), "cyrillic": "в н ский".split(), "greek": "κης ς".split()}

_GENDER = {name.casefold(): kind for kind, names in GIVEN.items() for name in names}
_WORD = r"[^\W\d_]++(?:['’-][^\W\d_]++)*+"
_LISTED = "|".join(sorted((x for names in GIVEN.values() for x in names), key=lambda x: (-len(x), x)))
#: An e-mail address from where a run of its characters starts; so a run is read once.
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[._%+-]*+(?P<local>[A-Za-z0-9][A-Za-z0-9._%+-]*+)@(?P<domain>[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+)")
_TOP = re.compile(r"[A-Za-z]{2,}")
#: Numbers, by kind, of bounded length each.
_NUMBER_KINDS = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.+-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w)|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)",
}
_NUMBER = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in _NUMBER_KINDS.items()))
_NAME = re.compile(rf"(?<!\w)(?:(?:{'|'.join(TITLES)})\.? (?:(?P<first>{_WORD}) )?(?P<last>{_WORD})|(?:{'|'.join(ADDRESS)})[:,]?\s(?P<called>{_WORD}) (?P<surname>{_WORD})|(?P<given>{_LISTED}) (?P<family>{_WORD}))(?!\w)")
_ANY_WORD = re.compile(_WORD)
_DIGIT = re.compile(r"\d")
_BEFORE_NAMES = frozenset(TITLES).union(ADDRESS, *GIVEN.values())


def may_name(text: str) -> bool:
    """False only where no name can be found: no title, word of address or given name as a word."""
    for c in _marks(text):
        text = text.replace(c, " ")
    return not _BEFORE_NAMES.isdisjoint(text.split())


def _marks(text: str) -> list[str]:
    """The characters of a text that end a word and aren't white space."""
    return [c for c in {*text} if not (c.isalnum() or c == "_" or c.isspace())]


def luhn(digits: str) -> int:
    """Sum that is 0 modulo 10 for a valid number."""
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def script(word: str) -> str:
    first = ord(word[0])
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 else "latin"


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, surface) in order; the parts of a name are entities of their own."""
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        for m in _EMAIL.finditer(text):
            labels = m["domain"].split(".")
            last = next((i for i in range(len(labels) - 1, 0, -1) if _TOP.match(labels[i])), 0)
            if last:
                end = m.start("domain") + len(".".join(labels[:last])) + 1 + _TOP.match(labels[last]).end()
                found.append((m.start("local"), end, "email"))
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            if m.lastgroup != "card" or 13 <= sum(c.isdigit() for c in m[0]) <= 19 and not luhn("".join(filter(str.isdigit, m[0]))):
                found.append((*m.span(), m.lastgroup))
    if may_name(text):
        found += named(text)
    out, at = [], 0
    for start, end, kind in sorted(found, key=lambda x: (x[0], -x[1])):
        if start >= at:
            out.append((start, end, kind, text[start:end]))
            at = end
    return out


def named(text: str) -> list[tuple[int, int, str]]:
    """Names by what stands before them, then all other mentions of the same names."""
    found: dict[int, tuple[int, int, str]] = {}
    for m in _NAME.finditer(text):
        parts = [g for g in ("first", "last", "called", "surname", "given", "family") if m[g]]
        if "called" in parts and any(m[g] in NO_NAMES or not m[g][0].isupper() for g in parts):
            continue
        for group in parts:
            start, end = m.start(group), m.start(group) + len(bare(m[group]))
            word = text[start:end]
            if not word[0].isupper() or script(word) == "latin" and not re.sub("['’-]", "", word[1:] or "x").isalpha():
                break
            gender = _GENDER.get(word.casefold()) if group in ("first", "called", "given") else None
            found[start] = (start, end, f"given:{gender[1]}" if gender else "family")
    kinds = {text[a:b].casefold(): kind for a, b, kind in found.values() if b - a > 1}
    if kinds:
        for m in _ANY_WORD.finditer(text):
            word = bare(m[0])
            kind = kinds.get(word.casefold()) if word[0].isupper() else None
            if kind and m.start() not in found:
                found[m.start()] = (m.start(), m.start() + len(word), kind)
    return [*found.values()]


def bare(word: str) -> str:
    """A name without the s of a genitive."""
    return word[:-2] if word.endswith(("'s", "’s")) and len(word) > 3 else word


def normal(kind: str, surface: str) -> str:
    if kind in ("card", "ssn", "phone", "iban"):
        return re.sub(r"[^A-Za-z0-9]", "", surface)
    return surface if kind == "ip" else surface.casefold()


class Draws:
    """A keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int) -> None:
        self.seed = f"{kind}\0{entity}\0{attempt}".encode()
        self.key, self.block, self.held = hashlib.blake2b(key).digest() if len(key) > 64 else key, 0, b""

    def below(self, n: int) -> int:
        if len(self.held) < 4:
            self.held = hashlib.blake2b(self.seed + self.block.to_bytes(4, "big"), key=self.key).digest()
            self.block += 1
        value, self.held = int.from_bytes(self.held[:4], "big"), self.held[4:]
        return value % n


def alike(c: str, draws: Draws) -> str:
    if c.isdigit():
        return str(draws.below(10))
    if c.isalpha() and c.isascii():
        return chr((65 if c.isupper() else 97) + draws.below(26))
    return c


def surrogate(kind: str, entity: str, attempt: int, key: bytes) -> str:
    """The replacement of a normalised entity, itself in normalised form."""
    for extra in count():  # never the entity itself
        found = _drawn(kind, entity, attempt + extra, Draws(key, kind, entity, attempt + (extra << 32)), key)
        if found != entity:
            return found


def _drawn(kind: str, entity: str, attempt: int, draws: Draws, key: bytes) -> str:
    more = attempt // WIDER  # characters beyond those of the entity
    if kind == "email":
        local, _, domain = entity.partition("@")
        labels = domain.split(".")
        if "example" not in labels[-2:]:
            own = Draws(key, "domain", domain, 0)
            labels = ["".join(alike(c, own) for c in x) for x in labels[:-1]] + labels[-1:]
        return "".join(alike(c, draws) for c in local + "x" * more) + "@" + ".".join(labels)
    if kind == "ip":
        first, *rest = map(int, entity.split("."))
        private = first in (10, 127) and not more
        return ".".join(map(str, [first if private else 1 + draws.below(223), *(draws.below(256) for _ in rest[:-1]), 1 + draws.below(254)])) + "".join(f".{draws.below(256)}" for _ in range(more // 2))
    if kind == "card":
        body = entity[0] + "".join(str(draws.below(10)) for _ in range(len(entity) - 2 + more))
        return body + next(d for d in "0123456789" if luhn(body + d) == 0)
    if kind == "iban":
        body = "".join(alike(c, draws) for c in entity[4:] + "0" * more)
        number = int("".join(str(int(c, 36)) for c in body + entity[:2] + "00"))
        return entity[:2] + f"{98 - number % 97:02d}" + body
    if kind == "ssn":
        return ("9" if not more else str(draws.below(10))) + "".join(str(draws.below(10)) for _ in entity[1:] + "0" * (more // 2))
    if kind == "phone":
        kept = 1 if len(entity) == 11 and entity[0] == "1" else 2 if len(entity) > 10 else 0
        return entity[:kept] + str(2 + draws.below(8)) + "".join(str(draws.below(10)) for _ in entity[kept + 1 :] + "0" * more)
    if kind.startswith("given"):
        names = GIVEN[script(entity), kind[-1]]
        order = sorted(range(len(names)), key=lambda i: hashlib.blake2b(names[i].encode(), key=key[:64]).digest())
        at = order.index(next(i for i, x in enumerate(names) if x.casefold() == entity))
        return names[order[(at + 1 + attempt) % len(names)]].casefold()  # a keyed cycle: no two share one
    own = script(entity)
    parts = max(2, min(4, len(entity) // 3)) + more
    return "".join(SYLLABLES[own][draws.below(len(SYLLABLES[own]))] for _ in range(parts)) + ENDINGS[own][draws.below(len(ENDINGS[own]))]


def formatted(kind: str, surface: str, found: str) -> str:
    """The surrogate in the format of a mention: its punctuation, spaces and letter case."""
    if kind in ("card", "ssn", "phone", "iban"):
        rest = iter(found)
        return "".join(next(rest, "") if c.isalnum() else c for c in surface) + "".join(rest)
    if kind == "email":
        return found.upper() if surface.isupper() else found
    if kind == "family" or kind.startswith("given"):
        return found.upper() if surface.isupper() and len(surface) > 1 else found.capitalize()
    return found


def replaced(text: str, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str, int]:
    out, at, n = [], 0, 0
    for start, end, kind, surface in entities(text):
        own = normal(kind, surface)
        out += text[at:start], formatted(kind, surface, surrogate(kind, own, attempts.get((kind, own), 0), key))
        at, n = end, n + 1
    return "".join(out) + text[at:], n


def mentions(df: DataFrame, text: str) -> DataFrame:
    """A row (body, kind, entity) for each different entity of each text; ``body`` is the text's hash."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(body, *pair) for body, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for pair in sorted({(k, normal(k, s)) for _, _, k, s in entities(x)})]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], ["body", "kind", "entity"])

    rows = df.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    return arrow_map(rows, found, "body long, kind string, entity string")


def later_attempts(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt) of the entities whose first surrogate is taken."""

    @F.arrow_udf(T.StringType())
    def drawn(kinds: pa.Array, names: pa.Array, attempts: pa.Array) -> pa.Array:
        return pa.array([surrogate(*x, key) for x in zip(kinds.to_pylist(), names.to_pylist(), attempts.to_pylist(), strict=True)], pa.string())

    family = F.regexp_replace("kind", ":.*", "")  # surrogates of all genders are one set
    current = stored(found.select("kind", "entity").distinct().withColumn("attempt", F.lit(0)), "entities")
    while True:
        made = stored(current.withColumn("made", drawn("kind", "entity", "attempt")).withColumn("family", family), "surrogates")
        shared = made.groupBy("family", "made").agg(F.min("entity").alias("owner"), F.count("*").alias("n")).where("n > 1").select("family", "made", "owner")
        real = made.select("family", F.col("entity").alias("made")).distinct().withColumn("is_real", F.lit(True))
        judged = made.join(shared, ["family", "made"], "left").join(real, ["family", "made"], "left")
        # names of one gender are dealt by a cycle, so that a surrogate may be another's given name
        clash = (F.col("owner").isNotNull() & (F.col("owner") != F.col("entity"))) | (F.col("is_real").isNotNull() & (F.col("family") != "given"))
        dropped(current)
        current = stored(judged.select("kind", "entity", F.coalesce(clash, F.lit(False)).alias("clash"), (F.col("attempt") + F.coalesce(clash, F.lit(False)).cast("int")).alias("attempt")), "entities")
        dropped(made)
        if not current.where("clash").take(1):
            return current.where("attempt > 0").select("kind", "entity", "attempt")


def pseudonymise(df: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``df`` with ``text`` replaced, and ``n_entities``, the number of mentions replaced. ``key`` is to be kept apart from the result."""
    df = df.drop("n_entities")
    found = stored(mentions(df, text), "mentions")
    later = later_attempts(found, key)
    names = df.columns
    at, last = names.index(text), len(names)
    by_text = found.distinct().join(later, ["kind", "entity"]).groupBy("body").agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("_later"))
    joined = df.withColumn("_body", F.xxhash64(text)).join(stored(by_text, "later"), F.col("_body") == F.col("body"), "left").drop("_body", "body")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(at).to_pylist(), batch.column(last).to_pylist(), strict=True)
            made = [(None, 0) if x is None else replaced(x, {(r["kind"], r["entity"]): r["attempt"] for r in own or ()}, key) for x, own in rows]
            columns = list(batch.columns[:last])
            columns[at] = pa.array([x for x, _ in made], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in made], pa.int64())], [*names, "n_entities"])

    return arrow_map(joined, write, T.StructType([*df.schema.fields, T.StructField("n_entities", T.LongType())]))


def key_of(spark: SparkSession) -> bytes:
    """The key in the settings; without one a new key, so that no one can go back from this run's surrogates."""
    found = spark.conf.get(KEY_SETTING, None)
    return found.encode() if found else os.urandom(32)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key_of(spark)).select("doc_id", "n_entities", "text")
