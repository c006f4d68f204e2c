import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from geolink.llm import bpe
from llm.edge_cases import TEXTS, clashing, documents, empty, plain

RANKS = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
OWN = bpe.Tokenizer(RANKS, public_tokenizers.PATTERN)
OTHER = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab aA 's\n\t\x1c\x85  é漢🙂'19.,!-_")), max_size=60))
def test_ids_equal_the_library(text):
    assert OWN.encode(text) == OTHER.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text_comes_back(text):
    ids = OWN.encode(text)
    assert ids == OTHER.encode_ordinary(text) and OWN.decode(ids) == text.encode()


@pytest.mark.parametrize("unit", ["a", "ab", "etaoin", " ", "é", "=-", "thonst"])
def test_long_pieces(unit):
    text = unit * 3000
    assert OWN.encode(text) == OTHER.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80), st.integers(0, 80))
def test_joining_halves_is_encoding_the_whole(data, at):
    own = OWN.encoder
    at = min(at, len(data))
    assert own.join(own.tree(data[:at]), own.tree(data[at:])) == tuple(own.merge(data))


def test_long_and_short_merges_agree():
    own = OWN.encoder
    for seed in range(50):
        rng = random.Random(seed)
        data = bytes(rng.choice(b"etaoinsh ") for _ in range(32))
        assert own._merge_long(data) == own._merge_short(data)


def test_edge_cases(spark):
    rows = bpe.encode_texts(clashing(spark)).collect()
    assert len(rows) == len(TEXTS)
    expected = sorted(
        (i is None, i, hashlib.sha256((t or "").encode()).hexdigest(), len(OTHER.encode_ordinary(t or "")))
        for i, t in TEXTS
        if i is not None
    )
    found = sorted((False, r.doc_id, r.decoded_sha256, r.n_tokens) for r in rows if r.doc_id is not None)
    assert found == expected
    assert bpe.encode_texts(empty(spark)).count() == 0


def test_decoding_a_table(spark):
    docs = documents(spark)
    decoded = bpe.decode_texts(bpe.encode_texts(docs)).select("doc_id", "decoded")
    expected = docs.selectExpr("doc_id", "cast(coalesce(text, '') AS binary)")
    assert plain(decoded) == plain(expected)
