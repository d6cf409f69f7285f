import random
import tracemalloc

import public_tokenizers
import pytest
import regex
import tiktoken

from censusloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def texts(seed, n):
    rng = random.Random(seed)
    alphabet = "abcdeinoth  \n\t\r\x1c\x85  '’sréß世界😀0123!?<|endoftext|>thingERS"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_transducer_matches_library(library):
    transducer = bpe.Transducer(bpe.load_ranks(PATH))
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in texts(1, 3000):
        ids = [int(i) for piece in pattern.findall(text) for i in transducer.encode(piece.encode()).split()]
        assert ids == library.encode_ordinary(text)
    rng = random.Random(2)
    for _ in range(3000):  # pieces that no pattern would make, also broken UTF-8
        piece = bytes(rng.choice(b"abcetinghors \xc3\xa9\xe4\xb8") for _ in range(rng.randrange(1, 60)))
        ids = [int(i) for i in transducer.encode(piece).split()]
        assert ids == library._core_bpe.encode_single_piece(piece)
        assert ids == list(transducer.stream(piece)) or piece in transducer.ranks


def test_lookahead_is_bounded():
    transducer = bpe.Transducer(bpe.load_ranks(PATH))
    read = 0

    def source():
        nonlocal read
        for byte in b"thereforeinternationalization" * 200:
            read += 1
            yield byte

    done = 0
    for token in transducer.stream(source()):
        done += len(transducer.bytes_of[token])
        assert read - done <= 2 * transducer.longest


def test_decoder_round_trip(library):
    bytes_of = {i: t for t, i in bpe.load_ranks(PATH).items()}
    for text in texts(3, 300):
        for at_once in (1, 2, 7):
            assert "".join(bpe.decode_stream(library.encode_ordinary(text), bytes_of, at_once)) == text
    machine = bpe.Utf8Stream()
    out = [machine.push(bytes([b])) for b in "é世😀a".encode()]
    assert [o.decode() for o in out if o] == list("é世😀a")
    assert "".join(bpe.decode_stream([bpe.load_ranks(PATH)[b"\xff"]], bytes_of)) == "�"


def test_documents(spark, library, monkeypatch):
    from hashlib import sha256

    docs = [(i, t) for i, t in enumerate(texts(4, 50))] + [(50, None), (51, ""), (51, ""), (None, "a b"), (52, "word " * 40000 + "x" * 3000)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_tokens int")
    rows = bpe.encode_documents(df, PATH, public_tokenizers.PATTERN, ids=True).collect()
    want = []
    for d, t in docs:
        ids = library.encode_ordinary(t or "")
        digest = sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((d, len(ids), digest, sha256((t or "").encode()).hexdigest(), ids))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe.encode_documents(df.where("false"), PATH, public_tokenizers.PATTERN).collect() == []


def test_kept_states_are_small():
    """Two workers of an executor keep hundreds of thousands of them."""
    transducer = bpe.Transducer(bpe.load_ranks(PATH))
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"abcdefghilmnoprstu") for _ in range(rng.randrange(4, 16))) for _ in range(4000)]
    tracemalloc.start()
    for piece in pieces:
        transducer.encode(piece)
    size = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(transducer._states) > 10_000
    assert size / len(transducer._states) < 750
