"""Token counts of whole texts; huge documents are encoded in overlapping chunks that are spliced where both agree.

A chunk starts anywhere, so its first pieces may be wrong, and its last ones may be cut. A place where the chunk
before and the chunk itself both begin a pre-tokenised piece is a true boundary if the chunk before is right up to
there: pieces are matched from left to right, look one character ahead at most, and special strings are shorter than
the guard that is kept from the chunk's end. From such a place on, the later chunk's tokens are the whole text's.
If the two agree nowhere, the overlap is doubled, and then the earlier chunk itself.

Other texts fall apart at the same boundaries: of a byte-level tokenizer every pre-tokenised piece is encoded by
itself, so the library encodes each different piece of many texts once, and a text has the sum of its pieces' tokens.
Texts that hold a special string, or a character whose class depends on the version of Unicode, go to the library whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from censusloom.llm.text import RELEASE

#: Characters of a chunk and of the overlap of two chunks; texts up to a chunk are encoded at once.
CHUNK, OVERLAP = 1 << 16, 256
#: Characters that are handed to the library at a time.
AT_ONCE = 1 << 19
#: Characters of the pieces whose counts a worker keeps, and pieces that are handed to the library at a time.
KEPT, PIECES = 1 << 22, 1 << 13
#: Pieces of a byte-level pre-tokenizer, and characters outside the blocks in which the library and regex agree on them.
BYTE_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
UNSURE = regex.compile("[^\x00-\u052f\u2000-\u206f\u20a0-\u20bf\u3000-\u30ff\u4e00-\u9fa5]")


@lru_cache(maxsize=2)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


RELEASE.append(load.cache_clear)


class Counter:
    """Token counts of texts, by those of their pieces where the tokenizer encodes each piece by itself."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        made = json.loads(tokenizer.to_str())
        cut, model = made["pre_tokenizer"] or {}, made["model"]
        self.by_piece = (
            (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")) == ("ByteLevel", True, False)
            and (made["normalizer"], model["type"], model["dropout"]) == (None, "BPE", None)
        )
        self.known: dict[str, int] = {}
        self.kept = 0

    def _encoded(self, texts: list[str]) -> Iterator[int]:
        for at in range(0, len(texts), PIECES):
            yield from map(len, self.tokenizer.encode_batch_fast(texts[at : at + PIECES], add_special_tokens=False))

    def _apart(self, text: str) -> bool:
        return self.by_piece and (text.isascii() or not UNSURE.search(text)) and not any(s in text for s in self.special)

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [BYTE_LEVEL.findall(t) if self._apart(t) else None for t in texts]
        if self.kept > KEPT:
            self.known, self.kept = {}, 0
        new = list(set().union(*[p for p in pieces if p is not None]) - self.known.keys())
        self.known.update(zip(new, self._encoded(new), strict=True))
        self.kept += sum(map(len, new))
        whole = self._encoded([t for t, p in zip(texts, pieces, strict=True) if p is None])
        return [next(whole) if p is None else sum(map(self.known.__getitem__, p)) for p in pieces]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(load(path))


RELEASE.append(counter.cache_clear)


def guard_of(tokenizer) -> int:
    """Characters before a chunk's end whose pieces may still change."""
    return 4 + max((len(t.content) for t in tokenizer.get_added_tokens_decoder().values()), default=0)


def _boundaries(tokenizer, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Where pieces of text[start:end] begin, how many tokens come before each, and the number of tokens."""
    found = tokenizer.encode(text[start:end], add_special_tokens=False)
    pieces = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
    begins = np.array([o[0] for o in found.offsets], np.int64)
    at = np.flatnonzero(np.diff(pieces, prepend=-2) != 0)
    return begins[at] + start, at, len(pieces)


def count_spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, never encoding much more than a chunk at a time."""
    guard, n = guard_of(tokenizer), len(text)
    start, end, cut, total = 0, min(n, chunk), 0, 0
    at, before, all_tokens = _boundaries(tokenizer, text, start, end)
    counted = 0  # tokens of this chunk that lie before cut
    while end < n:
        wide, spliced = overlap, False
        while not spliced:
            low = max(cut, end - wide)
            later = (low, min(n, low + max(chunk, 2 * wide)))
            next_at, next_before, next_all = _boundaries(tokenizer, text, *later)
            common, mine, theirs = np.intersect1d(at, next_at, assume_unique=False, return_indices=True)
            sure = np.flatnonzero((common > cut) & (common <= end - guard))
            if len(sure) and later[1] > end:
                k = sure[0]
                total += int(before[mine[k]]) - counted
                cut, counted, spliced = int(common[k]), int(next_before[theirs[k]]), True
                (start, end), at, before, all_tokens = later, next_at, next_before, next_all
            elif low > cut:
                wide *= 2
            else:
                break
        if not spliced:  # no boundary since the last splice: more text is needed, from the splice on
            start, end = cut, min(n, cut + 2 * (end - cut))
            at, before, all_tokens = _boundaries(tokenizer, text, start, end)
            counted = 0
    return total + all_tokens - counted


def count_tokens(df: DataFrame, path: str, limit: int = 512, text: str = "text", key: str = "doc_id", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of every whole text.

    Null counts as empty: 0 bytes, 0 tokens. A null key stays null; repeated rows give repeated results. Only key and
    text are read, so other columns cannot clash.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, short = load(path), counter(path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            counts = np.zeros(len(texts), np.int64)
            group, size = [], 0
            for i in [*range(len(texts)), None]:
                if group and (i is None or size + len(texts[i]) > AT_ONCE):
                    counts[group] = short.counts([texts[k] for k in group])
                    group, size = [], 0
                if i is None:
                    break
                if len(texts[i]) > chunk:
                    counts[i] = count_spliced(tokenizer, texts[i], chunk, overlap)
                else:
                    group.append(i)
                    size += len(texts[i])
            sizes = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(counts), pa.array(counts > limit)], [key, "n_bytes", "n_tokens", "over_limit"]
            )

    return df.select(key, text).mapInArrow(run, f"{key} {kind}, n_bytes long, n_tokens long, over_limit boolean")
