import base64
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitlake.llm.bpe import Bpe, bpe_decode, bpe_encode
from pitlake.llm.packing import load_encoder, pack, shortest_pack_first

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENCODE, PLAIN = load_encoder(JSON), Tokenizer.from_file(JSON)
TEXTS = ["", "a", "a" * 700, "-=" * 500, " \n" * 300, "日本語テキスト" * 50, "<|endoftext|> x", "it's we'll  12345 x² ﬃ", "\x00\x07\U0001f600"]


@pytest.fixture(scope="module")
def coder():
    return Bpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(coder, reference):
    ids, count = coder.encode(TEXTS)
    want = [reference.encode_ordinary(t) for t in TEXTS]
    assert count.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    assert coder.decode(ids.astype(np.int64), count) == [t.encode() for t in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_bpe_on_any_text(coder, reference, texts):
    ids, count = coder.encode(texts)
    assert ids.tolist() == sum((reference.encode_ordinary(t) for t in texts), [])
    assert coder.decode(ids.astype(np.int64), count) == [t.encode() for t in texts]


def test_bpe_frames(make, odd_rows, reference):
    got = bpe_decode(bpe_encode(make(odd_rows), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((i, t or "") for i, t in odd_rows if i is not None)
    assert sorted((r["doc_id"], bytes(r["decoded"]).decode()) for r in got) == want
    by_id = dict(want)
    assert all(r["ids"] == reference.encode_ordinary(by_id[r["doc_id"]]) for r in got)
    assert bpe_encode(make([(1, "x")]).limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_encoder_equals_tokenizers():
    plain, fast = Tokenizer.from_file(JSON), load_encoder(JSON)
    assert all(fast(t) == plain.encode(t, add_special_tokens=False).ids for t in TEXTS)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40)))
def test_every_piece_is_in_a_pattern(histogram):
    held = {}
    for lengths, count in shortest_pack_first(histogram, 32):
        assert sum(lengths) <= 32
        for n in lengths:
            held[n] = held.get(n, 0) + count
    assert held == histogram


def test_packing(make, odd_rows):
    plain = Tokenizer.from_file(JSON)
    rows = [*odd_rows, *((100 + i, "some words " * (i % 40)) for i in range(200))]
    got = pack(make(rows), JSON, size=64, bucket_rows=20).collect()
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    want = []
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, s, len(ids[s : s + 64]), zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 64)]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert pack(make([(1, "x")]).limit(0), JSON).collect() == []


def test_long_pieces(coder, reference):
    """Runs of any length go through the same matrices."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list(letters), n)) for letters in ("a", "ab", "aab", "etaoins", "abcdefghijklmnopqrstuvwxyz", "aé日") for n in (255, 256, 257, 600, 5_000, 30_000)]
    ids, count = coder.encode(texts)
    want = [reference.encode_ordinary(t) for t in texts]
    assert count.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="aé \n\t1'<|>endoftext-=", max_size=300))
def test_encoder_equals_tokenizers_on_any_text(text):
    assert list(ENCODE(text)) == PLAIN.encode(text, add_special_tokens=False).ids


def test_encoder_equals_tokenizers_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    for (text,) in rows:
        assert list(ENCODE(text or "")) == PLAIN.encode(text or "", add_special_tokens=False).ids
