import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from helpers import AWKWARD, EXTRA, documents

from blendwise.llm import bpe


@pytest.fixture(scope="module")
def pair():
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    return bpe.ByteBPE(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def test_matches_the_library_on_random_texts(pair):
    own, library = pair
    rng = random.Random(0)
    letters = [chr(i) for i in range(256)] + list(" 　 ​﻿\U0001F600́٠½一〇Ⅰ각")
    for _ in range(4000):
        text = "".join(rng.choice(letters if rng.random() < 0.5 else "abcdehrst  \n'") for _ in range(rng.randint(0, 40)))
        assert ids(own, text) == library.encode_ordinary(text), text
        assert own.decode(ids(own, text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, " " * 9000, "ab" * 9000, "\n" * 900 + "x", "the" * 5000, "!" * 9000, "a   b \n  c ",
                                  "<|endoftext|>", "it's  we'LL 's"])
def test_long_and_odd_pieces(pair, text):
    assert ids(pair[0], text) == pair[1].encode_ordinary(text)


def test_other_file_and_small_caches(pair, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 3)
    monkeypatch.setattr(bpe, "PAIRS", 5)
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own = bpe.ByteBPE(ranks, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for _, text in AWKWARD:
        assert ids(own, text or "") == library.encode_ordinary(text or "")


def test_dataframes(spark, pair):
    docs = documents(spark, AWKWARD, **EXTRA)
    path = P.path("byte_bpe_50k.tiktoken")
    out = bpe.decode(bpe.encode(docs, path, P.PATTERN), path)
    assert set(out.columns) == {*docs.columns, "decoded"}
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert np.frombuffer(r.ids, "<u4").tolist() == pair[1].encode_ordinary(r.text)
            assert bytes(r.decoded) == r.text.encode()
    assert bpe.encode(docs.limit(0), path, P.PATTERN).count() == 0
