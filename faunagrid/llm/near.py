"""N-gram Jaccard join with signature trees, and the groups of near copies it links.

A document's set holds the 64-bit hashes of its different shingles. Equal sets are one node
from the start. A signature tree holds in its leaves documents of like size, and in its nodes the
OR of their bitmaps, the range of set sizes and the largest number of tokens hidden by shared
bits. Trees are traversed together, and a pair of nodes is left as soon as the largest possible
overlap is too small, the sizes are too far apart, or both hold one linked group only. What
traversals find is verified on whole sets. Trees are built over documents that share a key, in three rounds:

1. Keys are a few combinations of minimum hashes. Only leaders, the smallest documents that no
   other has taken, are looked up in the tree, so that a large group is linked without its pairs.
2. Keys are prefix tokens: by the prefix filter, two sets can only reach the threshold if they share
   one of their first tokens in a common order, here rare tokens first (by a count sketch; any
   order is right, a rarer one is faster). Tokens whose documents are all linked already are done. The trees
   of a token of a few documents give the pairs to verify.
3. To the trees of tokens of many documents come whole sets, so that links are verified as they are found, and
   documents that are linked meanwhile are not compared: a tree gives at most as many links as documents.

Together, the second and the third make the join exact. A token of many documents is dealt to blocks, of one linked group
each where that has enough of them, and trees of blocks that hold the same group only are not brought together.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; a
text of fewer words than a shingle has its whole sequence as the only one; a null id has no
component; rows with equal ids and different texts are different sets of one node when that id
is the smallest of both, else separate; ids of other types than whole numbers are numbered in their
order first; other columns are not read by ``link``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faunagrid.llm.components import components
from faunagrid.llm.sketches import Bits, log_bits_for, merged, sliced
from faunagrid.llm.storage import arrow_map, dropped, stored, table, with_long

WORDS = 5
#: The threshold as a fraction: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Minimum hashes per star key, and keys.
STAR_ROWS, STAR_KEYS = 3, 5
#: Logarithms of the least and the most cells of the count sketch, which grows with the text. Beyond the most, a task would
#: send more than 4 MB; the order then tells tokens apart only if they are in more documents than others of a cell together.
LEAST_CELLS, MOST_CELLS = 12, 21
#: Documents of one key in one tree, and tokens in their sets, at about.
BLOCK, BLOCK_TOKENS = 1024, 1 << 19
LEAF = 8
#: Bits of a signature at least: where many documents meet, and where a few do.
LEAST_BITS, FEW_BITS = 2048, 256
#: Documents that a token of a few documents has at most.
SMALL = 64
#: Sets verified against one at a time by one task.
VERIFY = 256
#: Logarithm of the most bits that travel with tasks (16 MB); sets of more hashes are joined instead.
MOST_BITS = 27
#: Prefix tokens, at about, that one bucket gathers.
BUCKET_TOKENS = 1_000_000

_MIX = np.random.default_rng(5).integers(1 << 62, 1 << 63, 64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles. bytes.lower() and split() know A-Z and ASCII white space only."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    if len(h) < words:
        return mixed((h * _MIX[: len(h)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(h)))
    n = len(h) - words + 1
    total = np.zeros(n, np.uint64)
    for i in range(words):
        total += h[i : i + n] * _MIX[i]
    return np.unique(mixed(total))


def prefix_length(n: int) -> int:
    """Tokens of a set of n of which any set alike shares one, in a common order."""
    return n - -(-n * PERCENT // 100) + 1 if n else 0


def overlap_needed(n: int, m: int) -> int:
    """Smallest intersection of sets of n and m tokens alike."""
    return -(-(n + m) * PERCENT // (100 + PERCENT))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < PERCENT * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


# --- profiles: one pass over the texts ---

PROFILE = "id long, n long, k1 long, k2 long, stars array<long>, words binary, slice int, cells binary"


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for own, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
        yield own, shingles(text.as_buffer().to_pybytes() if text.is_valid else b"")


def profiles(docs: DataFrame, log_cells: int) -> DataFrame:
    """A row per document: size, digest and signature of the set, and star keys; and each task's slices of the count sketch."""
    size = 1 << log_cells

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.uint32)
        multipliers = _MIX[16 : 16 + STAR_ROWS * STAR_KEYS]
        some = False
        for batch in batches:
            rows: dict[str, list] = {"id": [], "n": [], "k1": [], "k2": [], "stars": [], "words": []}
            for own, tokens in _sets(batch):
                stars: list[int] = []
                digest = b"\0" * 16
                if len(tokens):
                    least = np.array([(tokens * m).min() for m in multipliers] if len(tokens) > 5000 else (tokens[None, :] * multipliers[:, None]).min(1)).reshape(STAR_KEYS, STAR_ROWS)
                    stars = mixed((least * _MIX[8 : 8 + STAR_ROWS]).sum(1, dtype=np.uint64) + np.arange(STAR_KEYS, dtype=np.uint64)).view(np.int64).tolist()
                    digest = xxhash.xxh3_128_digest(tokens.tobytes())
                    np.add.at(counts, (tokens & np.uint64(size - 1)).astype(np.int64), np.uint32(1))
                    some = True
                halves = np.frombuffer(digest, "<i8")
                for column, value in zip(rows.values(), (own, len(tokens), int(halves[0]), int(halves[1]), stars, bitmap(tokens).tobytes()), strict=True):
                    column.append(value)
            yield _profile_rows(rows, len(rows["id"]))
        if some:
            slices, cells = sliced(np.minimum(counts, 65535).astype(np.uint16))
            yield _sketch_rows(slices, cells)

    return arrow_map(docs, profile, PROFILE)


_PROFILE = ["id", "n", "k1", "k2", "stars", "words", "slice", "cells"]


def _profile_rows(rows: dict[str, list], n: int) -> pa.RecordBatch:
    longs = [pa.array(rows[c], pa.int64()) for c in ("id", "n", "k1", "k2")]
    return pa.RecordBatch.from_arrays([*longs, pa.array(rows["stars"], pa.list_(pa.int64())), pa.array(rows["words"], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], _PROFILE)


def _sketch_rows(slices: list[int], cells: list[bytes]) -> pa.RecordBatch:
    n = len(slices)
    return pa.RecordBatch.from_arrays([*(pa.nulls(n, pa.int64()) for _ in range(4)), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.binary()), pa.array(slices, pa.int32()), pa.array(cells, pa.binary())], _PROFILE)


class Order:
    """The common order of tokens: rarer classes of the sketch first, then by hash."""

    def __init__(self, counts: np.ndarray) -> None:
        self.classes = np.round(2 * np.log2(counts + 1.0)).astype(np.uint8)
        self.last = np.uint64(len(counts) - 1)

    def prefix(self, tokens: np.ndarray) -> np.ndarray:
        n = prefix_length(len(tokens))
        classes = self.classes[(tokens & self.last).astype(np.int64)]
        return tokens[np.argsort(classes, kind="stable")[:n]]  # tokens ascend, so ties go by hash


# --- verification on whole sets ---


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, tokens) of the documents whose ids are in ``ids`` (stored; a column id), and perhaps of a few more.

    The ids travel as bits with the tasks; if they are too many for that, the documents are joined with them.
    """
    known = docs.where("id IS NOT NULL").select("id", "text")
    log_bits = log_bits_for(ids.count())
    wanted = None
    if log_bits <= MOST_BITS:
        wanted = Bits.of(ids.select(F.xxhash64("id")), log_bits, _longs)
        known = known.withColumn("hash", F.xxhash64("id"))
    else:
        known = known.join(ids.select("id").distinct().hint("merge"), "id", "left_semi")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if wanted:
                batch = batch.filter(pa.array(wanted.has(_numbers(batch.column("hash")))))
            found = [(own, x.tobytes()) for own, x in _sets(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())], ["id", "tokens"])

    return arrow_map(known, made, "id long, tokens binary")


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _longs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield _numbers(batch.column(0))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are alike. Pairs are dealt by b, large groups in parts."""
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / VERIFY).cast("int").alias("parts"))
    members = pairs.join(parts, "b").select("b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.col("a").alias("id"))
    centres = parts.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("b").alias("id"))
    asked = members.withColumn("role", F.lit(1)).unionByName(centres.withColumn("role", F.lit(0)))
    held = asked.join(sets.hint("merge"), "id").select("b", "part", "role", "id", "tokens").repartition("b", "part").sortWithinPartitions("b", "part", "role")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for b, part, role, own, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = np.frombuffer(tokens, np.uint64)
                if (b, part) != at:
                    at, centre = (b, part), []
                if not role:
                    centre.append(tokens)
                elif any(alike(tokens, x) for x in centre):
                    out.append((own, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["a", "b"])

    return arrow_map(held, check, "a long, b long")


# --- signature trees ---


def bitmap(tokens: np.ndarray, least: int = LEAST_BITS) -> np.ndarray:
    """A signature of at least two bits a token, and ``least`` of short texts, as 64-bit words."""
    bits = max(least, min(1 << 16, 1 << (2 * len(tokens) - 1).bit_length()))
    out = np.zeros(bits >> 6, np.uint64)
    at = (tokens >> np.uint64(20)) & np.uint64(bits - 1)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def folded(words: np.ndarray, length: int) -> np.ndarray:
    """A narrower signature of the same set: the OR of the parts."""
    return np.bitwise_or.reduce(words.reshape(-1, length), 0) if len(words) > length else words


class Member:
    __slots__ = ("comp", "hidden", "id", "n", "pos", "tokens", "words")

    def __init__(self, own: int, comp: int, n: int, pos: int, words: np.ndarray, tokens: np.ndarray | None = None) -> None:
        self.id, self.comp, self.n, self.pos, self.words, self.tokens = own, comp, n, pos, words, tokens
        self.hidden = n - int(np.bitwise_count(words).sum())  # tokens that share a bit with others


def most_shared(x: Member, y: Member) -> int:
    """Largest possible overlap of two sets by their signatures.

    Shared tokens stand on bits that both have set; at most as many more of either as share a bit.
    """
    if len(x.words) == len(y.words):
        return int(np.bitwise_count(x.words & y.words).sum()) + max(0, min(x.hidden, y.hidden))
    length = min(len(x.words), len(y.words))
    a, b = folded(x.words, length), folded(y.words, length)
    hidden = min(x.n - int(np.bitwise_count(a).sum()), y.n - int(np.bitwise_count(b).sum()))
    return int(np.bitwise_count(a & b).sum()) + max(0, hidden)


def may_be_alike(x: Member, y: Member) -> bool:
    n, m = x.n, y.n
    if x.comp == y.comp or 100 * min(n, m) < PERCENT * max(n, m):
        return False
    needed = overlap_needed(n, m)
    return min(n - x.pos, m - y.pos) >= needed and most_shared(x, y) >= needed


class Node:
    """The OR of the signatures below, with the ranges of sizes, places and hidden tokens."""

    __slots__ = ("below", "comp", "high", "length", "low", "members", "pos", "words")

    def __init__(self, members: list[Member], below: list[Node]) -> None:
        self.members, self.below = members, below
        parts = below or members
        self.length = min(len(x.words) for x in parts)
        self.words = np.bitwise_or.reduce([folded(x.words, self.length) for x in parts], 0)
        if below:
            self.low, self.high = min(x.low for x in below), max(x.high for x in below)
            self.pos = min(x.pos for x in below)
            comps = {x.comp for x in below}
        else:
            self.low, self.high = min(x.n for x in members), max(x.n for x in members)
            self.pos = min(x.pos for x in members)
            comps = {x.comp for x in members}
        self.comp = comps.pop() if len(comps) == 1 else None

    def narrow(self, length: int) -> tuple[np.ndarray, int]:
        """The signature folded, and the most tokens that it hides in any one document below."""
        hidden = max(x.narrow(length)[1] for x in self.below) if self.below else max(x.hidden if len(x.words) == length else x.n - int(np.bitwise_count(folded(x.words, length)).sum()) for x in self.members)
        return folded(self.words, length), hidden


def tree(members: list[Member]) -> Node:
    """Members of like size and signature stand together."""
    members = sorted(members, key=lambda x: (x.n, x.words.tobytes()[:16], x.id))
    level = [Node(members[i : i + LEAF], []) for i in range(0, len(members), LEAF)]
    while len(level) > 1:
        level = [Node([], level[i : i + LEAF]) for i in range(0, len(level), LEAF)]
    return level[0]


def possible(a: Node, b: Node) -> bool:
    """Whether some document of one node may be alike with some of another group in the other."""
    if a.comp is not None and a.comp == b.comp or 100 * a.high < PERCENT * b.low or 100 * b.high < PERCENT * a.low:
        return False
    needed = overlap_needed(a.low, b.low)
    if min(a.high - a.pos, b.high - b.pos) < needed:  # as the first common token, with those after it
        return False
    length = min(a.length, b.length)
    (x, h), (y, k) = a.narrow(length), b.narrow(length)
    return int(np.bitwise_count(x & y).sum()) + max(0, min(h, k)) >= needed


def leaves(a: Node, b: Node) -> Iterator[tuple[Node, Node]]:
    """Pairs of leaves that may hold documents alike, by traversing two trees together (or one with itself)."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if not possible(a, b):
            continue
        if a.members and b.members:
            yield a, b
        elif a is b:
            parts = a.below
            stack += [(x, y) for i, x in enumerate(parts) for y in parts[i:]]
        elif a.below and (not b.below or a.high - a.low >= b.high - b.low):
            stack += [(x, b) for x in a.below]
        else:
            stack += [(a, x) for x in b.below]


def candidates(a: Node, b: Node) -> Iterator[tuple[int, int]]:
    """Pairs that may be alike."""
    for p, q in leaves(a, b):
        for i, x in enumerate(p.members):
            for y in p.members[i + 1 :] if p is q else q.members:
                if may_be_alike(x, y):
                    yield (x.id, y.id) if x.id > y.id else (y.id, x.id)


def links_of(a: Node, b: Node) -> Iterator[tuple[int, int]]:
    """Pairs that are alike, by members' tokens, as far as earlier ones (or groups) do not link both ends already."""
    parent: dict[int, int] = {}

    def group(x: Member) -> int:
        at = x.comp
        while (up := parent.get(at, at)) != at:
            parent[at] = at = parent.get(up, up)
        return at

    for p, q in leaves(a, b):
        if len({group(x) for x in p.members} | {group(x) for x in q.members}) == 1:
            continue
        for i, x in enumerate(p.members):
            for y in p.members[i + 1 :] if p is q else q.members:
                one, other = group(x), group(y)
                if one != other and may_be_alike(x, y) and alike(x.tokens, y.tokens):
                    parent[max(one, other)] = min(one, other)
                    yield (x.id, y.id) if x.id > y.id else (y.id, x.id)


def lookup(root: Node, member: Member) -> Iterator[Member]:
    """What of a tree may be alike with a document, by traversing the tree with the tree of that one."""
    own = Node([member], [])
    stack = [root]
    while stack:
        node = stack.pop()
        if node.members:
            yield from (x for x in node.members if may_be_alike(x, member))
        elif possible(node, own):
            stack += node.below


def led(members: list[Member]) -> Iterator[tuple[int, int]]:
    """Pairs (document, leader): each document of smallest id that none has taken leads those that may be alike with it."""
    root = tree(members)
    taken: set[int] = set()
    for leader in sorted(members, key=lambda x: x.id):
        if leader.id not in taken:
            for x in lookup(root, leader):
                if x.id not in taken:
                    taken.add(x.id)
                    yield x.id, leader.id


def star_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) to verify of documents that share a star key, from nodes (rep, n, words, stars)."""
    keyed = nodes.select("rep", F.explode("stars").alias("star"))
    sizes = keyed.groupBy("star").agg(F.count("*").alias("size"), F.min("rep").alias("least")).where("size > 1")
    sizes = sizes.select("star", "least", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts"))
    dealt = keyed.join(sizes, "star").select("rep", "star", F.when(F.col("rep") != F.col("least"), F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).alias("part"), "parts")
    # the smallest document of a key is in all its parts, so that it leads in each
    dealt = dealt.select("rep", "star", F.explode(F.when(F.col("part").isNotNull(), F.array("part")).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).alias("part"))
    dealt = dealt.join(nodes.select("rep", "n", "words").hint("merge"), "rep").repartition("star", "part").sortWithinPartitions("star", "part")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, int]]:
            for _, group in groupby(_rows(batches, "star", "part", "rep", "n", "words"), key=lambda r: r[:2]):
                yield from led([Member(rep, rep, n, 0, np.frombuffer(words, np.uint64)) for _, _, rep, n, words in group])

        yield from _pair_rows(pairs())

    return arrow_map(dealt, join, "a long, b long").where("a <> b").distinct()


def token_links(postings: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between groups of documents that share a token, from postings (token, id, comp, n, pos) and (id, tokens)."""
    parts = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_TOKENS)).cast("int")
    of = postings.groupBy("token", "comp").agg(F.count("*").alias("size"), F.sum("n").alias("n"), parts.alias("parts"))
    own = of.where(F.col("size") >= BLOCK).select("token", "comp", "parts")
    pool = of.where(F.col("size") < BLOCK).groupBy("token").agg(F.ceil(F.greatest(F.sum("size") / BLOCK, F.sum("n") / BLOCK_TOKENS)).cast("int").alias("pooled"))
    label = F.xxhash64("owner", "part")
    blocks = own.select("token", F.col("comp").alias("owner"), "parts").unionByName(pool.select("token", F.lit(None).cast("long").alias("owner"), F.col("pooled").alias("parts")))
    blocks = blocks.select("token", "owner", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select("token", "owner", label.alias("block"))
    # a block meets itself and every other, but for those of the same group alone
    apart = ~F.coalesce(F.col("x.owner") == F.col("y.owner"), F.lit(False))
    met = blocks.alias("x").join(blocks.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.block") <= F.col("y.block")) & apart).select("x.token", F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    sides = met.select("token", F.col("i").alias("block"), "i", "j").unionByName(met.where("i <> j").select("token", F.col("j").alias("block"), "i", "j"))
    placed = postings.join(own, ["token", "comp"], "left").join(pool, "token", "left")
    placed = placed.withColumn("owner", F.when(F.col("parts").isNotNull(), F.col("comp"))).withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", "pooled")).cast("int"))
    placed = placed.select("token", "id", "comp", "n", "pos", label.alias("block")).join(sides, ["token", "block"])
    placed = placed.join(nodes.select(F.col("rep").alias("id"), "words").hint("merge"), "id")
    dealt = placed.join(sets.hint("merge"), "id").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, int]]:
            for (_, i, j), group in groupby(_rows(batches, "token", "i", "j", "block", "id", "comp", "n", "pos", "words", "tokens"), key=lambda r: r[:3]):
                sides: tuple[list[Member], list[Member]] = ([], [])
                for _, _, _, block, own, comp, n, pos, words, tokens in group:
                    sides[block != i].append(Member(own, comp, n, pos, np.frombuffer(words, np.uint64), np.frombuffer(tokens, np.uint64)))
                if i == j:
                    root = tree(sides[0])
                    yield from links_of(root, root)
                elif sides[0] and sides[1]:
                    yield from links_of(tree(sides[0]), tree(sides[1]))

        yield from _pair_rows(pairs())

    return arrow_map(dealt, join, "a long, b long").where("a <> b").distinct()


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _pair_rows(pairs: Iterator[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Different pairs, a bounded number at a time."""
    while True:
        some = {*islice(pairs, 20_000)}
        if not some:
            return
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in some], pa.int64()), pa.array([x for _, x in some], pa.int64())], ["a", "b"])


# --- prefixes ---


def prefixes(docs: DataFrame, order: Order) -> DataFrame:
    """(id, n, prefix, words): the first tokens of each document's set, and its signature where a few documents meet."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(own, len(x), order.prefix(x).tobytes(), bitmap(x, FEW_BITS).tobytes()) for own, x in _sets(batch) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["id", "n", "prefix", "words"])

    return arrow_map(docs.where("id IS NOT NULL").select("id", "text"), made, "id long, n long, prefix binary, words binary")


def shared_tokens(held: DataFrame, buckets: int) -> DataFrame:
    """(bucket, tokens): packed tokens that documents of different groups have in their prefixes.

    ``held``: (prefix, comp). Each task sends every bucket one packed row for each batch: tokens, and for each the
    smallest and largest group that the batch has for it.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x, np.uint64) for x in batch.column(0).to_pylist()]
            if not parts:
                continue
            tokens = np.concatenate(parts)
            comps = np.repeat(batch.column(1).to_numpy(), [len(x) for x in parts])
            tokens, low, high = _spans(tokens, comps, comps)
            at = (tokens >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(at, kind="stable")
            cuts = np.searchsorted(at[order], np.arange(buckets + 1, dtype=np.uint64))
            rows = [(k, order[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), *(pa.array([values[x].tobytes() for _, x in rows], pa.binary()) for values in (tokens, low, high - low))], ["bucket", "tokens", "low", "width"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, group in groupby(_rows(batches, "bucket", "tokens", "low", "width"), key=lambda r: r[0]):
            tokens, low, width = (np.concatenate([np.frombuffer(x, kind) for x in column]) for column, kind in zip(list(zip(*group, strict=True))[1:], (np.uint64, np.int64, np.int64), strict=True))
            tokens, low, high = _spans(tokens, low, low + width)
            found = tokens[low < high]
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(found)], pa.int64()), pa.array([found.tobytes()], pa.binary())], ["bucket", "n", "tokens"])

    packed = arrow_map(held.select("prefix", "comp"), pack, "bucket int, tokens binary, low binary, width binary")
    return arrow_map(packed.repartition("bucket").sortWithinPartitions("bucket"), meet, "bucket int, n long, tokens binary")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column("tokens").to_pylist():
            yield np.frombuffer(x, np.uint64)


def _spans(tokens: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each different token the smallest low and the largest high."""
    order = np.argsort(tokens, kind="stable")
    tokens = tokens[order]
    starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.empty(0, np.int64)
    if not len(starts):
        return tokens, low[order], high[order]
    return tokens[starts], np.minimum.reduceat(low[order], starts), np.maximum.reduceat(high[order], starts)


POSTINGS = ["token", "id", "comp", "n", "pos"]
_LONGS = ", ".join(f"{c} long" for c in POSTINGS)


def open_postings(held: DataFrame, shared: DataFrame) -> DataFrame:
    """(token, id, comp, n, pos) for the prefix tokens that are shared (stored), or may be.

    The tokens travel as bits with the tasks; if they are too many for that, all postings are joined with them.
    """
    log_bits = log_bits_for(shared.agg(F.sum("n")).first()[0] or 0)
    wanted = Bits.of(shared.select("tokens"), log_bits, _packed) if log_bits <= MOST_BITS else None

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for own, n, prefix, comp in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "prefix", "comp")), strict=True):
                prefix = np.frombuffer(prefix, np.uint64)
                at = np.flatnonzero(wanted.has(prefix)) if wanted else np.arange(len(prefix))
                for column, values in zip(out, (prefix[at].view(np.int64), np.full(len(at), own), np.full(len(at), comp), np.full(len(at), n), at), strict=True):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in out], POSTINGS)

    found = arrow_map(held.select("id", "n", "prefix", "comp"), made, _LONGS)
    if wanted:
        return found

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _packed(batches):
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], ["token"])

    return found.join(arrow_map(shared.select("tokens"), spread, "token long").hint("merge"), "token", "left_semi")


def meeting(postings: DataFrame) -> DataFrame:
    """The postings without those whose token brings together no two documents of fitting sizes and places; and whether a token has ``many``.

    Needs no signatures, which are long for long texts, and leaves tokens of many documents as they are.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, group in groupby(_rows(batches, *POSTINGS), key=lambda r: r[0]):
                few = list(islice(group, SMALL + 1))
                if len(few) > SMALL:
                    yield from ((*row, True) for row in chain(few, group))
                    continue
                meets = set()
                for i, (_, _, comp, n, pos) in enumerate(few):
                    for j in range(i + 1, len(few)):
                        _, _, other, m, at = few[j]
                        if comp != other and 100 * min(n, m) >= PERCENT * max(n, m) and min(n - pos, m - at) >= overlap_needed(n, m):
                            meets |= {i, j}
                yield from ((*few[i], False) for i in sorted(meets))

        found = rows()
        while some := [*islice(found, 10_000)]:
            columns = [*zip(*some, strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.bool_())], [*POSTINGS, "many"])

    return arrow_map(postings.repartition("token").sortWithinPartitions("token"), kept, _LONGS + ", many boolean")


def token_pairs(postings: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs (a, b) to verify of documents that share one of the tokens, each of a few documents; ``words``: (id, words)."""
    dealt = postings.join(words.hint("merge"), "id").repartition("token").sortWithinPartitions("token")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, int]]:
            for _, group in groupby(_rows(batches, *POSTINGS, "words"), key=lambda r: r[0]):
                root = tree([Member(own, comp, n, pos, np.frombuffer(words, np.uint64)) for _, own, comp, n, pos, words in group])
                yield from candidates(root, root)

        yield from _pair_rows(pairs())

    return arrow_map(dealt, join, "a long, b long").where("a <> b").distinct()


# --- the join ---


def link(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each row of ``df`` in no order: the groups that links connect."""
    kind = df.schema[key].dataType
    docs = with_long(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "id")
    if kind.typeName() in ("byte", "short", "integer", "long"):
        return groups(docs.select("id", "text"))
    docs = stored(docs, "numbered")  # numbered once for all passes
    names = docs.where("id IS NOT NULL").select("id", "key").distinct()
    found = groups(docs.select("id", "text")).join(names, "id", "left").withColumnsRenamed({"key": "own", "id": "number"})
    component = names.select(F.col("id").alias("component_id"), F.col("key").alias("component"))
    return found.join(component, "component_id", "left").select(F.col("own").alias("id"), "n_shingles", F.col("component").alias("component_id"))


def groups(docs: DataFrame) -> DataFrame:
    """``link`` for documents (id long, text)."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    log_cells = min(MOST_CELLS, max(LEAST_CELLS, (chars // 8).bit_length()))
    found = stored(profiles(docs, log_cells), "profiles")
    order = Order(_sketch(found, 1 << log_cells))
    rows = found.where("slice IS NULL").select("id", "n", "k1", "k2", "stars", "words")
    same = ["stars", "n", "words"]
    nodes = stored(rows.where("n > 0 AND id IS NOT NULL").groupBy("k1", "k2").agg(F.min("id").alias("rep"), *(F.first(c).alias(c) for c in same)), "nodes")

    # 1: leaders of star keys
    pairs = stored(star_pairs(nodes), "star-pairs")
    ids = stored(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "star-ids")
    links = [stored(verified(pairs, sets_of(docs, ids)), "star-links")]
    dropped(pairs, ids)

    # 2: prefix tokens of a few documents
    reps = nodes.select(F.col("rep").alias("id")).distinct()
    held = stored(prefixes(docs, order).join(led_by(reps, links[0]).hint("merge"), "id"), "prefixes")
    total = held.agg(F.sum(F.length("prefix"))).first()[0] or 0
    shared = stored(shared_tokens(held, max(64, total // (8 * BUCKET_TOKENS))), "shared-tokens")
    met = stored(meeting(open_postings(held, shared)), "met")
    pairs = stored(token_pairs(met.where("NOT many").drop("many"), held.select("id", "words")), "token-pairs")
    dropped(held, shared)
    many = met.where("many").drop("many")
    ids = stored(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).unionByName(many.select("id")).distinct(), "open-ids")
    sets = stored(sets_of(docs, ids), "open-sets")
    links.append(stored(verified(pairs, sets), "pair-links"))

    # 3: prefix tokens of many documents
    links.append(stored(token_links(many, nodes, sets), "token-links"))
    dropped(pairs, met, ids, sets)

    joined = components(reduce(DataFrame.unionByName, links)).withColumnRenamed("node", "rep")
    labelled = nodes.join(joined, "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    by_set = rows.join(labelled, ["k1", "k2"], "left")
    result = stored(by_set.select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")), "linked")
    dropped(found, nodes, *links)
    return result


def led_by(ids: DataFrame, links: DataFrame) -> DataFrame:
    """(id, comp): of each id its leader's leader by the links, or its leader, or itself. Ids of one comp are linked."""
    up = links.groupBy("a").agg(F.min("b").alias("b"))
    first, second = up.withColumnsRenamed({"a": "id", "b": "one"}), up.withColumnsRenamed({"a": "one", "b": "two"})
    return ids.join(first, "id", "left").join(second, "one", "left").select("id", F.coalesce("two", "one", "id").alias("comp"))


def _sketch(found: DataFrame, size: int) -> np.ndarray:
    """The count sketch of all tasks."""
    wide = found.where("slice IS NOT NULL").select("slice", "cells")
    return merged(wide, "<u2", np.add, size, "<u4")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP4_SQL = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(list_slice(w, i, i + {WORDS - 1}), ' ')) END) AS shingle
    FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * common >= {PERCENT} * (x.n + y.n - common)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id JOIN reach r ON d.doc_id = r.doc_id GROUP BY d.doc_id
"""
