"""Byte-level BPE and token counts against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from stockweave.llm.byte_bpe import Codec, PerfectHash, encoded_digests, read_ranks
from stockweave.llm.token_counts import Counter, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    " ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "é", "ñ", "²", "½", "Ⅷ", "٣", "中", "🙂", "é", "_", "-",
    "'s", "'S", "n't", "a", "Bc", "1", "23", ".", "!!", "\x00", "ʼ", "ǅ", "<|endoftext|>", "<|endof", "한국", "thonreh",
]


@pytest.fixture(scope="module")
def codec():
    return Codec(read_ranks(RANKS), memo_size=50)


@pytest.fixture(scope="module")
def library():
    ranks = {token: i for i, token in enumerate(read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def samples():
    rng = random.Random(5)
    yield from ("", "a" * 3000, " " * 2000, "ab" * 1000)
    for _ in range(1500):
        yield "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))


def test_codec_equals_the_library_and_round_trips(codec, library):
    for text in samples():
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_counts_equal_the_library():
    counter, library = Counter(open(MODEL, encoding="utf-8").read(), memo_size=50), Tokenizer.from_file(MODEL)
    for text in samples():
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_shortcut_is_proven_for_each_string():
    counter = Counter(open(MODEL, encoding="utf-8").read())
    assert len(counter.single) > 50_000 and all(counter.merged(v) == 1 for v in list(counter.single)[:2000])


def test_perfect_hash_is_minimal_and_exact():
    keys = [b"%d" % i for i in range(5000)]
    table = PerfectHash(keys)
    assert sorted(table.slot) == list(range(5000))
    assert [table.get(k) for k in keys] == list(range(5000)) and table.get(b"x") == -1


def test_queries_on_odd_rows(odd, empty, odd_rows, library):
    rows = encoded_digests(odd, RANKS).collect()
    assert len(rows) == len(odd_rows)
    expected = sorted(
        (
            str(i),
            len(library.encode_ordinary(t or "")),
            hashlib.sha256(np.array(library.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest(),
            hashlib.sha256((t or "").encode()).hexdigest(),
        )
        for i, t in odd_rows
    )
    assert sorted((str(r[0]), *r[1:]) for r in rows) == expected
    counted = token_counts(odd, MODEL)
    assert sorted(r["n_bytes"] for r in counted.collect()) == sorted(len((t or "").encode()) for _, t in odd_rows)
    assert encoded_digests(empty, RANKS).count() == 0 and token_counts(empty, MODEL).count() == 0
