"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

The merge list of a byte-level BPE is compiled into a transducer over bytes, one state at a time, when a byte is first
read in that state. After any prefix, the last token of the prefix's encoding is the one suffix token that the merges
leave standing next to the last token before it. A state therefore holds the bytes after the last token that is certain,
with the last token of every prefix within these bytes. A token is emitted as soon as all prefixes from which a longer
token may still start agree on it, so the lookahead is bounded by the longest token. The certain token itself is kept in
a register beside the state: a move asks at most once whether a token may stand next to it, and has a target for either
answer. So states do not multiply by the tokens before them.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from censusloom.llm.text import RELEASE, forget

#: Pieces kept with their ids, and transitions kept; beyond that the tables start anew. This bounds memory only.
CACHED_PIECES = 120_000
CACHED_STATES = 300_000
#: Bytes at the start of a piece that are read in one move once they are known.
HEAD = 6
#: Longer pieces are not kept.
CACHED_LENGTH = 64
#: Pieces of a text that are held at a time.
PIECES_AT_ONCE = 1 << 16
_START, _NONE, _NEVER = -1, -1, 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes one pre-tokenised piece after the other.

    A state is (ends, starts), packed as integers of 32 bits: for each prefix of the bytes after the last certain token
    its last token with that token's length, as token << 8 | length (-1: no longer needed); and the places where a token
    may start whose bytes so far are the start of longer tokens, each after its node in the tree of all tokens. The last
    of them is the end, after the root. A move is (token it asks about or _NONE, target << 8, emitted code, last token
    emitted); of one that asks nothing and emits nothing only the target is kept.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        if self.longest > 255:
            raise ValueError("tokens of more than 255 bytes are not supported")
        self._tree()
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._agree: dict[int, bool] = {}
        self._reset()

    def _tree(self) -> None:
        """Tree of the tokens: node << 8 | byte -> next node, the token that ends at each node, and the inner nodes.

        The integers of a token and its code are made once, as a hundred thousand moves hold them.
        """
        self._next: dict[int, int] = {}
        self._ends_at = [_NONE]
        inner = set()
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                inner.add(node)
                node = self._next.setdefault(node << 8 | byte, len(self._ends_at))
                if node == len(self._ends_at):
                    self._ends_at.append(_NONE)
            self._ends_at[node] = rank
        self._emits = {rank: (b" %d" % rank, rank) for rank in self.ranks.values()}
        self._inner = bytearray(len(self._ends_at))
        for node in inner:
            self._inner[node] = 1

    def _reset(self) -> None:
        self._states = [array("i", (0, 0)).tobytes()]
        self._numbers = {self._states[0]: 0}
        self._plain: dict[int, int] = {}
        self._moves: dict[int, tuple[int, int, bytes, int]] = {}
        self._denied: dict[int, tuple[int, int, bytes, int]] = {}
        self._last: dict[int, bytes] = {}
        self._heads: dict[bytes, tuple[int, int, bytes]] = {}

    def merge(self, piece: bytes, below: int = _NEVER) -> list[int]:
        """The merges themselves, lowest rank first, leftmost first; only those below a rank."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [self.ranks.get(piece[i : i + 2], _NEVER) for i in range(len(piece) - 1)]
        while ranks and (best := min(ranks)) < below:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.ranks.get(parts[i - 1] + parts[i], _NEVER)
            if i < len(ranks):
                ranks[i] = self.ranks.get(parts[i] + parts[i + 1], _NEVER)
        return [self.ranks[p] for p in parts]

    def _halves_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merge into this one last; (token, token) for a byte, None if merges never make it."""
        if token not in self._halves:
            data = self.bytes_of[token]
            parts = self.merge(data, token)
            self._halves[token] = (token, token) if len(data) == 1 else (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def _stands(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens side by side.

        They do if each token comes about by itself and no merge across the border comes before the merge that hides
        one of its sides. So the last merges of both sides are undone, the later first: what touches the border is
        then a smaller pair, that must not merge with a rank below the one undone last (from the left: or equal).
        """
        pair = left << 32 | right
        known = self._agree.get(pair)
        if known is not None:
            return known
        if len(self._agree) > CACHED_STATES:
            self._agree.clear()
        known = self._agree[pair] = self._halves_of(left) is not None and self._halves_of(right) is not None and self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        rank_of, bytes_of, limit = self.ranks.get, self.bytes_of, _NEVER
        while True:
            if rank_of(bytes_of[left] + bytes_of[right], _NEVER) < limit:
                return False
            a, b = self._halves_of(left)[1], self._halves_of(right)[0]
            if a == left and b == right:
                return True
            # The later merge is undone first. A pair across the border with the same rank as a merge to its right
            # stands further left and goes first; to its left, later.
            if b == right or a != left and left > right:
                limit, left = left, a
            else:
                limit, right = right + 1, b

    def _step(self, move: int, granted: bool) -> tuple[int, int, bytes, int]:
        """Makes the move from state << 8 by a byte, where the token it asks about may stand or not, and its target."""
        byte, state = move & 255, array("i", self._states[move >> 8]).tolist()
        n = state[-1]
        ends, first = state[:n], n
        n += 1
        follow, ends_at, inner, halves, stands = self._next.get, self._ends_at, self._inner, self._halves_of, self._stands
        open_, meet, found, asked = [], [], False, _NONE
        for k in range(first, len(state), 2):
            node = follow(state[k] << 8 | byte)
            if node is None:
                continue
            j = state[k + 1]
            if inner[node]:
                open_ += node, j
                meet.append(j)
            token = ends_at[node]
            if found or token == _NONE or halves(token) is None:
                continue
            if not j:
                asked, found = token, granted
            else:
                found = stands(ends[j - 1] >> 8, token)
            if found:
                ends.append(token << 8 | n - j)
        # A later token may start at the open places and here; the paths to them meet at the last certain boundary.
        open_ += 0, n
        meet.append(n)
        while len(meet) > 1:
            place = meet.pop()
            parent = place - (ends[place - 1] & 255)
            if parent not in meet:
                meet.append(parent)
                meet.sort()
        cut, code, last = meet[0], b"", _NONE
        if cut:
            code, last = self._path(ends, cut)
            alive, kept = {cut}, []
            for i, end in enumerate(ends[cut:], cut + 1):
                if end >= 0 and i - (end & 255) in alive:
                    alive.add(i)
                    kept.append(end)
                else:
                    kept.append(-1)
            for k in range(0, len(open_), 2):
                if open_[k + 1] in alive:
                    kept += open_[k], open_[k + 1] - cut
            ends = kept
        else:
            ends += open_
        state = array("i", ends).tobytes()
        target = self._numbers.get(state)
        if target is None:
            target = self._numbers[state] = len(self._states) << 8
            self._states.append(state)
        if asked == _NONE and not code:
            self._plain[move] = target
            return asked, target, code, last
        made = (self._moves if granted else self._denied)[move] = (asked, target, code, last)
        return made

    def _path(self, ends: Sequence[int], j: int) -> tuple[bytes, int]:
        """Code of the first j bytes, and the last token of it."""
        out = []
        while j:
            out.append(ends[j - 1] >> 8)
            j -= ends[j - 1] & 255
        code, last = self._emits[out[0]]
        return (code if len(out) == 1 else self.code_of(reversed(out))), last

    def _rest(self, state: int) -> bytes:
        ends = array("i", self._states[state])
        code = self._last[state] = self._path(ends, ends[-1])[0] if ends[-1] else b""
        return code

    @staticmethod
    def code_of(tokens: Iterable[int]) -> bytes:
        """Ids in decimal, each after a space: the transducer's output alphabet."""
        return b"".join([b" %d" % t for t in tokens])

    def _move(self, state: int, byte: int, root: int) -> tuple[int, int, bytes, int]:
        """The move from state << 8 by a byte, after the certain token root; made if it is new."""
        move = state | byte
        after = self._plain.get(move)
        if after is not None:
            return _NONE, after, b"", _NONE
        made = self._moves.get(move) or self._step(move, True)
        if made[0] != _NONE and root != _START and not self._stands(root, made[0]):
            made = self._denied.get(move) or self._step(move, False)
        return made

    def stream(self, piece: Iterable[int]) -> Iterator[int]:
        """Tokens of a piece as soon as they are certain."""
        state, root = 0, _START
        for byte in piece:
            _, state, code, last = self._move(state, byte, root)
            if code:
                root = last
                yield from map(int, code.split())
        yield from map(int, (self._last.get(state >> 8) or self._rest(state >> 8)).split())

    def encode(self, piece: bytes) -> bytes:
        """Code of a whole piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return b" %d" % whole
        if len(self._plain) + len(self._moves) + len(self._denied) > CACHED_STATES:
            self._reset()
        head = piece[:HEAD]
        state, root, code = self._heads.get(head) or self._begin(head)
        state, _, more = self._read(state, root, piece[HEAD:])
        return code + more + (self._last.get(state >> 8) or self._rest(state >> 8))

    def _begin(self, head: bytes) -> tuple[int, int, bytes]:
        """State, certain token and code after the first bytes of a piece, which are read at once when they come again."""
        if len(self._heads) >= CACHED_PIECES:
            self._heads.clear()
        made = self._heads[head] = self._read(0, _START, head)
        return made

    def _read(self, state: int, root: int, data: bytes) -> tuple[int, int, bytes]:
        """State, certain token and code after some bytes."""
        plain, known, agree, codes = self._plain.get, self._moves.get, self._agree.get, []
        for byte in data:
            after = plain(state | byte)
            if after is None:
                asked, after, code, last = known(state | byte) or self._step(state | byte, True)
                if asked != _NONE and root != _START and not agree(root << 32 | asked):
                    _, after, code, last = self._move(state, byte, root)
                if code:
                    root = last
                    codes.append(code)
            state = after
        return state, root, b"".join(codes)


class Utf8Stream:
    """Hands on whole characters only; up to three bytes of an unfinished one wait for the next call."""

    def __init__(self) -> None:
        self.pending = b""

    def push(self, data: bytes) -> bytes:
        data = self.pending + data
        keep = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                if back < (2 if byte < 0xE0 else 3 if byte < 0xF0 else 4):
                    keep = len(data) - back
                break
            if byte < 0x80:
                break
        self.pending = data[keep:]
        return data[:keep]

    def finish(self) -> bytes:
        data, self.pending = self.pending, b""
        return data


def decode_stream(ids: Iterable[int], bytes_of: dict[int, bytes], at_once: int = 4096) -> Iterator[str]:
    """Text of a stream of ids; bytes that are no UTF-8 become U+FFFD."""
    machine, ids = Utf8Stream(), iter(ids)
    while chunk := list(islice(ids, at_once)):
        yield machine.push(b"".join(map(bytes_of.__getitem__, chunk))).decode("utf-8", "replace")
    yield machine.finish().decode("utf-8", "replace")


class _Codes(dict):
    """Piece -> its ids in decimal, each after a space; filled by the transducer. The last full table is kept behind.

    Pieces that are one token are always there.
    """

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer, self.before, self.tokens = transducer, {}, {}
        for token, rank in transducer.ranks.items():
            try:
                self.tokens[token.decode()] = b" %d" % rank
            except UnicodeDecodeError:  # bytes that are no text are no piece
                continue
        self.update(self.tokens)

    def __missing__(self, piece: str) -> bytes:
        code = self.before.get(piece) or self.transducer.encode(piece.encode())
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES + len(self.tokens):
                self.before = {p: c for p, c in self.items() if p not in self.tokens}
                self.clear()
                self.update(self.tokens)
            self[piece] = code
        return code


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> tuple:
    transducer = Transducer(load_ranks(path))
    return regex.compile(pattern), _Codes(transducer), {b"%d" % i: t for i, t in transducer.bytes_of.items()}


RELEASE.append(_codec.cache_clear)


def _groups(found: Callable, text: str) -> Iterator[list[str]]:
    """Pieces of a text, some at a time."""
    if len(text) <= PIECES_AT_ONCE:
        yield found.findall(text)
        return
    matches = found.finditer(text)
    while some := [m.group() for m in islice(matches, PIECES_AT_ONCE)]:
        yield some


def encode_documents(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id", ids: bool = False) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids, of every whole text.

    Each match of the pattern is encoded by itself, without special tokens. Null counts as empty: no ids, the digests
    of nothing. A null key stays null; repeated rows give repeated results. Only key and text are read.
    """
    kind = df.schema[key].dataType.simpleString()
    fields = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        found, codes, bytes_of = _codec(path, pattern)
        # The tables are millions of objects without cycles: looking through them for garbage again and again is in vain.
        collecting = gc.isenabled()
        gc.disable()
        try:
            yield from encoded(batches, found, codes, bytes_of)
        finally:
            if collecting:
                gc.enable()

    def encoded(batches: Iterator[pa.RecordBatch], found: regex.Pattern, codes: _Codes, bytes_of: dict[bytes, bytes]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, number, ends = [], array("i"), array("i", (0,))
            for value in batch.column(1):
                n, coded, decoded, machine = 0, sha256(), sha256(), Utf8Stream()
                for pieces in _groups(found, value.as_py() or ""):
                    code = b"".join(map(codes.__getitem__, pieces))
                    listed = code.split()
                    coded.update(code if n else code[1:])
                    decoded.update(machine.push(b"".join(map(bytes_of.__getitem__, listed))))
                    n += len(listed)
                    if ids:
                        number.extend(map(int, listed))
                decoded.update(machine.finish())
                rows.append((n, coded.hexdigest(), decoded.hexdigest()))
                ends.append(len(number))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 3
            arrays = [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                values = pa.Array.from_buffers(pa.int32(), len(number), [None, pa.py_buffer(number)])
                arrays.append(pa.ListArray.from_arrays(pa.Array.from_buffers(pa.int32(), len(ends), [None, pa.py_buffer(ends)]), values))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return df.select(key, text).mapInArrow(run, fields)
