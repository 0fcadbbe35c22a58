"""Ids against the reference encoder, and the round trip."""

import base64
import os

import pytest
import tiktoken

from folioforge.llm.tokenize import DEFAULT_VOCABULARY, decode, encode

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_VOCABULARY), reason="no vocabulary")

TEXTS = [
    "", None, " ", "\n\n  \t x", "Hello, world! It's 2024; they'll've gone.", "naïve café — “quotes”… 🙏🏽 👩‍👩‍👧", "日本語のテキスト נר λύχνος", "<|endoftext|> is text <|startoftext|>",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20, "x" * 3000, "1234567890" * 30, "a b c　d\u0085e​f", "ȩ́ ẛ̣", "\x00\x01\x7f", "!?!?...---___===" * 9, "word " * 2000, "don't DON'T 'S 'll 'LL", "İı ſ ﬁ",
    "퟿￿",
]


def encoder():
    from public_tokenizers import PATTERN

    with open(DEFAULT_VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_words(spark):
    """Words of thousands of bytes are folded in stretches, with the ids of the whole."""
    import random
    import time

    rng = random.Random(5)
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ab", "etaoins", "日本語漢字文書検索", "กขคงจฉชซ", "éèüößñ", "xyz" * 3 + "ing", "AaBb"]
    texts = ["".join(rng.choice(k) for _ in range(n)) for k in kinds for n in (100, 193, 400, 2500)] + ["understanding" * 90, "z" * 1000, "0123456789" * 40, "-=" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    enc = encoder()
    assert all(list(r.ids) == enc.encode_ordinary(r.text) for r in encode(df, dictionary_words=1).collect())
    one = spark.createDataFrame([(1, "".join(rng.choice(kinds[0]) for _ in range(20_000)))], "doc_id bigint, text string")
    began = time.perf_counter()
    assert len(encode(one, dictionary_words=1).first().ids) > 5000 and time.perf_counter() - began < 20  # minutes, if it were folded as one


@pytest.mark.parametrize("words", [20_000, 1])
def test_ids(spark, words):
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate([*TEXTS, *TEXTS[:6]])], "doc_id bigint, text string, word string").repartition(3)
    enc = encoder()
    out = encode(df, dictionary_words=words)
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 6
    for r in rows:
        assert list(r.ids) == (enc.encode_ordinary(r.text) if r.text else []), r.text
    back = decode(out, out="back").collect()
    assert all(r.back == (r.text or "") for r in back)


def test_empty_and_unknown(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert encode(df).count() == 0
    ids = spark.createDataFrame([([],), (None,), ([15496, 999_999, -1],)], "ids array<int>")
    assert [r.text for r in decode(ids).collect()] == ["", None, "Hello"]
