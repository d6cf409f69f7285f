import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from censusloom.llm import token_count

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["<|endoftext|>", "<|endof", "text|>", " the", "  ", "\n\n", "foo", "é", "123", "'s", "世界", "x" * 90, " " * 40]


@pytest.mark.parametrize("seed", range(4))
def test_spliced_counts_match_library(seed):
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(seed)
    for _ in range(500):
        text = "".join(rng.choice(PIECES) if rng.random() < 0.4 else rng.choice("ab \n<|é'1") for _ in range(rng.randrange(300)))
        assert token_count.count_spliced(tokenizer, text, 64, 16) == len(tokenizer.encode(text, add_special_tokens=False))


def test_no_common_boundary_widens():
    tokenizer = Tokenizer.from_file(PATH)
    for text in ("x" * 30000, "word " * 200 + "y" * 9000 + " end" * 500, " " * 5000):
        assert token_count.count_spliced(tokenizer, text, 1024, 64) == len(tokenizer.encode(text, add_special_tokens=False))


def test_documents(spark):
    tokenizer = Tokenizer.from_file(PATH)
    docs = [(1, "a b <|endoftext|> c"), (2, None), (3, ""), (3, ""), (None, "é" * 600), (4, "some words " * 12000)]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, n_bytes string")
    want = []
    for d, t in docs:
        n = len(tokenizer.encode(t or "", add_special_tokens=False))
        want.append((d, len((t or "").encode()), n, n > 512))
    assert sorted(map(tuple, token_count.count_tokens(df, PATH).collect()), key=str) == sorted(want, key=str)
    assert token_count.count_tokens(df.where("false"), PATH).collect() == []


class Watched:
    """A tokenizer that lists what it is given to encode."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **how):
        self.given += texts
        return self.tokenizer.encode_batch_fast(texts, **how)


@pytest.mark.parametrize("seed", range(4))
def test_counts_by_piece_match_library(seed, monkeypatch):
    monkeypatch.setattr(token_count, "KEPT", 2000)
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(seed)
    counter, some = token_count.Counter(tokenizer), ["\u0558", "\U00010940", "\x1c", "\x85", "\u2028", "\u00a0", "“"]
    for _ in range(40):
        texts = ["".join(rng.choice([*PIECES, *some]) if rng.random() < 0.4 else rng.choice("ab \n<|é'1") for _ in range(rng.randrange(90))) for _ in range(20)]
        assert counter.counts(texts) == [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]


def test_a_piece_is_encoded_once():
    watched = Watched(Tokenizer.from_file(PATH))
    counter = token_count.Counter(watched)
    assert counter.counts(["the end the end", "the end"]) == [4, 2]
    assert counter.counts(["the end"]) == [2]
    assert sorted(watched.given) == [" end", " the", "the"]


def test_characters_of_the_blocks_fall_into_the_same_pieces():
    cut = Tokenizer.from_file(PATH).pre_tokenizer
    sure = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and not token_count.UNSURE.match(chr(c))]
    text = "".join(f"a{c}b\n1{c}2\n !{c}! " for c in sure)
    assert [m.span() for m in token_count.BYTE_LEVEL.finditer(text)] == [o for _, o in cut.pre_tokenize_str(text)]


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}])
def test_other_tokenizers_get_whole_texts(change):
    with open(PATH) as file:
        tokenizer = Tokenizer.from_str(json.dumps(json.load(file) | change))
    texts = ["e\u0301te", "the end", "the end 12's"]
    watched = Watched(tokenizer)
    assert token_count.Counter(watched).counts(texts) == [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    assert watched.given == texts
