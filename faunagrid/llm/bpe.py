"""Byte-level BPE encoding and decoding with a rank queue.

Each pre-token is a doubly linked list of byte positions. A queue holds, for every merge
rank, a bucket of list positions whose pair has that rank; a two-level bitmap over the
ranks tells the lowest bucket that is not empty by two find-first-set steps. Popping a
bucket takes its leftmost position; an entry whose pair has changed since is stale and is
skipped. The cost of a merge does not depend on the length of the pre-token, so that very
long ones stay near linear. Short pre-tokens that a worker has not met before are encoded
many at a time: one such queue over all their lists, whose buckets are NumPy arrays.

Defined cases: a null text is encoded as the empty one (no tokens); ids outside the
vocabulary raise ``ValueError`` on decoding; other columns are not read, so that clashing names
do no harm; repeated rows are encoded independently.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunagrid.llm.storage import arrow_map, table

#: Pre-tokens that a worker remembers, from task to task, unless told otherwise (some 120 MB); then it starts anew.
CACHE_ENTRIES = 600_000
#: Longer pre-tokens are not remembered, and each has a queue of its own.
CACHE_BYTES = 64
#: Bytes of unknown pre-tokens that are encoded at a time.
CHUNK_BYTES = 1_000_000
#: Bytes of text, at about, that a worker encodes at a time, and code points whose pre-tokens it holds.
TEXT_BYTES, SPLIT_CHARS = 3_500_000, 3_500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Positions by merge rank; ``pop`` gives the leftmost position of the lowest rank."""

    __slots__ = ("buckets", "summary", "words")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.summary = 0
        self.words: dict[int, int] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word = rank >> 6
        self.words[word] = self.words.get(word, 0) | 1 << (rank & 63)
        self.summary |= 1 << word

    def pop(self) -> tuple[int, int]:
        word = (self.summary & -self.summary).bit_length() - 1
        bits = self.words[word]
        rank = word << 6 | (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.words[word] = bits = bits & (bits - 1)
            if not bits:
                self.summary &= self.summary - 1
        return rank, position


class Codec:
    """Encodes and decodes by one vocabulary and one pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.cache: dict[str, tuple[int, ...]] = {}
        self.most = CACHE_ENTRIES
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.none = (max(ranks.values()) >> 6) + 1 << 6  # no rank, and in a word of its own
        self.width = self.none + 1
        pairs = {ranks[t[:i]] * self.width + ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([*map(pairs.__getitem__, self.pair_keys.tolist()), self.none], np.int64)

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Tokens of one pre-token: the lowest-ranked adjacent pair merges first, the leftmost of equals."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        rank_of, n = self.ranks.get, len(piece)
        following = list(range(1, n + 1))  # of a live position: where the next one starts
        before = list(range(-1, n - 1))
        pair: list[int | None] = [rank_of(piece[i : i + 2]) for i in range(n - 1)]
        pair.append(None)
        queue = RankQueue()
        at_start: dict[int, list[int]] = {}
        for i, rank in enumerate(pair):
            if rank is not None:
                at_start.setdefault(rank, []).append(i)
        for rank, positions in at_start.items():
            queue.push(rank, positions[0])
            if len(positions) > 1:
                queue.buckets[rank] = positions  # ascending, so already a heap
        push, pop = queue.push, queue.pop
        while queue.summary:
            rank, i = pop()
            if pair[i] != rank:
                continue  # stale
            j = following[i]
            end = following[j]
            following[i] = end
            pair[j] = None
            if end < n:
                before[end] = i
                pair[i] = new = rank_of(piece[i : following[end]])
                if new is not None:
                    push(new, i)
            else:
                pair[i] = None
            if i:
                k = before[i]
                pair[k] = new = rank_of(piece[k:end])
                if new is not None:
                    push(new, k)
        out, i, ranks = [], 0, self.ranks
        while i < n:
            end = following[i]
            out.append(ranks[piece[i:end]])
            i = end
        return tuple(out)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of tokens."""
        keys = left * self.width + right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], self.none)

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Tokens of many short, non-empty pre-tokens: a single rank queue over all their lists."""
        lengths = np.array([len(x) for x in pieces])
        n, none = int(lengths.sum()), self.none
        ends = np.cumsum(lengths)
        starts = ends - lengths
        token = np.append(self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)], none)  # the last place stands for no position
        following = np.append(np.arange(1, n + 1), n)
        following[ends - 1] = n
        before = np.arange(-1, n)
        before[starts] = n
        owner = np.repeat(np.arange(len(pieces)), lengths)
        rank = np.append(self.ranks_of(token[:n], token[following[:n]]), none)
        alive = np.ones(n, bool)
        words: dict[int, list[np.ndarray]] = {}  # by 64 ranks: positions
        summary = 0

        def deal(positions: np.ndarray) -> None:
            nonlocal summary
            own = rank[positions] >> 6
            order = np.argsort(own, kind="stable")
            own = own[order]
            cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
            for word, part in zip(own[np.append(0, cuts)].tolist(), np.split(positions[order], cuts), strict=True):
                words.setdefault(word, []).append(part)
                summary |= 1 << word

        if (live := np.flatnonzero(rank < none)).size:
            deal(live)
        while summary:
            word = (summary & -summary).bit_length() - 1
            summary &= summary - 1
            held = np.unique(np.concatenate(words.pop(word)))
            held = held[rank[held] >> 6 == word]
            order = held[np.argsort(rank[held], kind="stable")]
            if not order.size:
                continue
            of = rank[order]
            cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
            buckets = {r: [x] for r, x in zip(of[np.append(0, cuts)].tolist(), np.split(order, cuts), strict=True)}
            bits = 0
            for r in buckets:
                bits |= 1 << (r & 63)
            later: list[np.ndarray] = []
            while bits:
                low = (bits & -bits).bit_length() - 1
                r = word << 6 | low
                i = buckets.pop(r)
                i = i[0] if len(i) == 1 else np.unique(np.concatenate(i))
                i = i[rank[i] == r]  # without the stale
                first = np.ones(i.size, bool)
                first[1:] = owner[i[1:]] != owner[i[:-1]]
                rest, i = i[~first], i[first]  # of each pre-token the leftmost; the others after it
                if rest.size:
                    buckets[r] = [rest]
                else:
                    bits ^= 1 << low
                if not i.size:
                    continue
                j = following[i]
                end, k = following[j], before[i]
                token[i], following[i], before[end], rank[j], alive[j] = r, end, i, none, False
                rank[i] = self.ranks_of(token[i], token[end])
                rank[k] = self.ranks_of(token[k], token[i])
                rank[n] = none
                new = np.concatenate((i, k))
                new = new[rank[new] < none]
                if not new.size:
                    continue
                at = rank[new] >> 6
                lowest = int(at.min())
                if lowest > word:
                    later.append(new)
                    continue
                near = new[at == word]
                of = rank[near]
                for own in set(of.tolist()):
                    buckets.setdefault(own, []).append(np.sort(near[of == own]))
                    bits |= 1 << (own & 63)
                later.append(new[at != word])
                if lowest < word:  # those come first
                    later += (x for own in buckets.values() for x in own)
                    break
            if later:
                new = np.concatenate(later)
                if (new := new[rank[new] < none]).size:
                    deal(new)
        live = np.flatnonzero(alive)
        found = token[live].tolist()
        cuts = np.searchsorted(live, np.append(starts, n)).tolist()
        return [tuple(found[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def learn(self, split: list[list[str]]) -> None:
        """Encodes and remembers the short pre-tokens of some texts that are not known yet."""
        unknown = set().union(*split)
        if len(self.cache) + len(unknown) > self.most:
            self.cache.clear()
        unknown.difference_update(self.cache)
        todo, data, held = [], [], 0
        for x in unknown:
            piece = x.encode()
            if len(piece) > CACHE_BYTES:
                continue
            todo.append(x)
            data.append(piece)
            held += len(piece)
            if held >= CHUNK_BYTES:
                self.cache.update(zip(todo, self.encode_pieces(data), strict=True))
                todo, data, held = [], [], 0
        if todo:
            self.cache.update(zip(todo, self.encode_pieces(data), strict=True))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text; the pre-tokens of one text, or of a few short ones, are held at a time."""
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (end == start or held + len(texts[end]) <= SPLIT_CHARS):
                held += len(texts[end])
                end += 1
            split = [self.pieces(text) for text in texts[start:end]]
            self.learn(split)
            known = self.cache
            for pieces in split:
                try:
                    yield [*chain.from_iterable(map(known.__getitem__, pieces))]
                except KeyError:  # long ones among them
                    yield [*chain.from_iterable(known.get(x) or self.encode_piece(x.encode()) for x in pieces)]
            start = end

    def decode(self, ids: list[int]) -> bytes:
        try:
            return b"".join(map(self.tokens.__getitem__, ids))
        except KeyError as unknown:
            raise ValueError(f"unknown token id {unknown}") from None

    def decimal(self, ids: list[int]) -> str:
        return " ".join(map(self.names.__getitem__, ids))


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Batches joined until they hold ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.nbytes for x in held) >= size:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec a worker process, kept between tasks."""
    return Codec(read_ranks(path), pattern)


def encode_texts(df: DataFrame, path: str, pattern: str, text: str | Column = "text", into: str = "tokens") -> DataFrame:
    """``df`` with the column ``into``: an array of token ids. ``path`` must exist on every executor."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encoded(texts: pa.Array) -> pa.Array:
        c = codec(path, pattern)
        return pa.array(list(c.encode_all(texts.to_pylist())), pa.list_(pa.int32()))

    return df.withColumn(into, encoded(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))))


def decode_tokens(df: DataFrame, path: str, pattern: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """``df`` with the column ``into``: the bytes of the token ids in ``tokens`` (null: none)."""

    @F.arrow_udf(T.BinaryType())
    def decoded(ids: pa.Array) -> pa.Array:
        c = codec(path, pattern)
        return pa.array((c.decode(x.as_py() or []) for x in ids), pa.binary())

    return df.withColumn(into, decoded(F.col(tokens)))


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", remembered: int = CACHE_ENTRIES) -> DataFrame:
    """Per row its key, n_tokens, and SHA-256 of the decimal ids and of the bytes decoded from them.

    Encodes, then decodes within one pass, so that the ids never leave the worker, which remembers so many pre-tokens.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType

    def digests(batches):
        c = codec(path, pattern)
        c.most = remembered
        for part in gathered(batches, TEXT_BYTES):
            n, ids_hash, text_hash = [], [], []
            for ids in c.encode_all(part.column(1).to_pylist()):
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(c.decimal(ids).encode()).hexdigest())
                text_hash.append(hashlib.sha256(c.decode(ids)).hexdigest())
            made = pa.Table.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])
            yield from made.to_batches()

    schema = T.StructType([T.StructField("key", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return arrow_map(rows, digests, schema).withColumnRenamed("key", key)


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path and pre-token pattern of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), *vocabulary())
