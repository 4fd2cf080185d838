import hashlib
import random

import pytest
import tiktoken
from faunagrid.llm import bpe

PATH, PATTERN = bpe.vocabulary()
RANKS = bpe.read_ranks(PATH)
CODEC = bpe.Codec(RANKS, PATTERN)
PUBLIC = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
DOCS = "/root/testdata/sf0.001/documents.parquet"


def texts():
    rng = random.Random(3)
    yield from ("", " ", "\n\n a", "aaaaaaaa", "x" * 5000, "ab" * 3000, "ññ" * 900, "日本語テキスト", "don't we'll", "\0\x01", "12345678901", "  \t\n  x", "👩‍👩‍👧 a")
    for _ in range(300):
        yield "".join(rng.choice("aab etTh'sé \n\t1,.!日x-") for _ in range(rng.randrange(300)))


def test_equal_to_the_public_encoder():
    for text in texts():
        ids = CODEC.encode(text)
        assert ids == PUBLIC.encode_ordinary(text)
        assert CODEC.decode(ids) == text.encode()


def test_many_at_a_time_as_one_by_one():
    pieces = sorted({p.encode() for t in texts() for p in CODEC.pieces(t) if 0 < len(p.encode()) <= bpe.CACHE_BYTES})
    assert CODEC.encode_pieces(pieces) == [CODEC.encode_piece(p) for p in pieces]
    whole = sorted(RANKS)[::7]
    assert CODEC.encode_pieces([x for x in whole if len(x) <= 64]) == [CODEC.encode_piece(x) for x in whole if len(x) <= 64]


def test_both_queues_agree_on_either_side_of_the_bound():
    rng = random.Random(12)
    for n in range(bpe.CACHE_BYTES - 4, bpe.CACHE_BYTES + 5):
        pieces = sorted({"".join(rng.choice("abcdeghinorst") for _ in range(n)).encode() for _ in range(20)} | {b"ab" * (n // 2), b"e" * n})
        assert CODEC.encode_pieces(pieces) == [CODEC.encode_piece(p) for p in pieces]
        for piece in pieces:
            assert CODEC.encode(piece.decode()) == PUBLIC.encode_ordinary(piece.decode())


def test_the_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 50)
    codec = bpe.Codec(RANKS, PATTERN)
    assert codec.most == 50
    for text in texts():
        assert codec.encode(text) == PUBLIC.encode_ordinary(text)


def test_unknown_ids():
    with pytest.raises(ValueError, match="unknown"):
        CODEC.decode([999_999])


def test_queue_pops_lowest_then_leftmost():
    queue, rng = bpe.RankQueue(), random.Random(1)
    entries = [(rng.randrange(500), rng.randrange(100)) for _ in range(300)]
    for rank, position in entries:
        queue.push(rank, position)
    assert [queue.pop() for _ in entries] == sorted(entries)
    assert not queue.summary


def test_columns_and_round_trip(spark):
    df = spark.createDataFrame([(1, "Hello world", "x"), (2, None, "y"), (1, "Hello world", "z")], "doc_id long, text string, tokens string")
    got = bpe.decode_tokens(bpe.encode_texts(df, PATH, PATTERN), PATH, PATTERN).orderBy("doc_id").collect()
    assert [bytes(r.decoded) for r in got] == [b"Hello world", b"Hello world", b""]
    assert got[0].tokens == PUBLIC.encode_ordinary("Hello world") and got[2].tokens == []
    assert bpe.round_trip(df.where("false"), PATH, PATTERN).count() == 0


def test_query(spark):
    got = {r.doc_id: r for r in bpe.op1_bpe_round_trip(spark, "/root/testdata/sf0.001").collect()}
    for row in spark.read.parquet(DOCS).collect():
        ids = PUBLIC.encode_ordinary(row.text or "")
        own = got.pop(row.doc_id)
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
    assert not got
