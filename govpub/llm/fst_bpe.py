"""Byte-level BPE as a finite-state transducer.

The merges are compiled, as texts need them, into a deterministic transducer that reads bytes and writes token ids.

Two adjacent tokens are *compatible* if merging their joined bytes gives back exactly these two tokens. A token sequence
is the BPE result of its bytes if and only if every token merges to itself and all neighbours are compatible: a merge
across a boundary of the whole sequence would be the first one to cross there, and nothing before it could have come from outside
the two tokens, so it would also happen to the pair alone. The nondeterministic machine therefore has states (last
token, bytes of the next token so far). The subset construction keeps, per live state, the tokens not yet written,
and writes whatever all live states agree on. A state lives on only while its bytes start some token, so the lookahead is
below the longest token. States and steps are made when a text first needs them and kept in a table of bounded
size. Long runs without a split (a megabyte of blanks) cost one step per byte.

Equal to the rank-based encoding that merges the lowest rank first, leftmost on ties, piece by piece of the splitting
pattern, where a piece that is itself a token is that token.

Decoding joins the tokens' bytes chunk by chunk; an incremental UTF-8 machine holds back the bytes of an unfinished
character, so text can be read while tokens arrive.

Defined results: a null text encodes as the empty one, to no tokens; ill-formed bytes of a text are read as U+FFFD, and
those of ids decode to U+FFFD; repeated
rows are encoded one by one; no rows give no rows. Texts are read whole. Rows never move: one scan, no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import batch, map_batches, valid

#: Steps and pieces that a process keeps before it starts anew.
MAX_STEPS, MAX_PIECES = 500_000, 400_000
#: Tokens decoded at a time.
CHUNK = 65_536
NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def halves(ranks: dict[bytes, int], token: bytes) -> tuple[bytes, bytes] | None:
    """The two tokens whose merge makes this one from its bytes; None if its bytes merge otherwise."""
    parts = [token[i: i + 1] for i in range(len(token))]
    while len(parts) > 2:
        joins = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        if (best := min(joins)) == NEVER:
            return None
        at = joins.index(best)
        parts[at: at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class Transducer:
    """Lazily determinised byte-to-token machine of one vocabulary.

    A live state is (tokens not yet written, last token or -1, node of the trie of all tokens); node 0 is the root.
    """

    def __init__(self, ranks: dict[bytes, int], max_steps: int = MAX_STEPS):
        self.ranks, self.max_steps = ranks, max_steps
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.child: dict[int, int] = {}  # node << 8 | byte -> node
        self.token: list[int] = [-1]  # node -> token that ends there
        for token, number in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                node = self.child[key]
            self.token[node] = number
        self.pairs: dict[int, bool] = {}
        self.made_of: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.live: dict[tuple, tuple] = {}  # equal live states are one object
        self.start = self.number((((), -1, 0),))

    def number(self, state: tuple) -> int:
        found = self.numbers.get(state)
        if found is None:
            state = tuple(self.live.setdefault(x, x) for x in state)
            found = self.numbers[state] = len(self.states)
            self.states.append(state)
        return found

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        found = self.made_of.get(token, 0)
        if found == 0:
            found = self.made_of[token] = halves(self.ranks, token)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together merge to just these two.

        Merges are undone from the last one back: the pair at the border between them exists until the next merge takes one
        of its sides, so it merges itself if its rank is lower (or, to the right, the same, as the leftmost goes first).
        """
        b = self.bytes_of[right]
        if len(b) > 1 and self.split(b) is None:
            return False
        if left < 0:
            return True
        fits = self.pairs.get(key := left << 32 | right)
        if fits is not None:
            return fits
        if len(self.pairs) >= self.max_steps:
            self.pairs.clear()
        rank, a, of_a, of_b, until_a, until_b = self.ranks.get, self.bytes_of[left], left, right, NEVER, NEVER
        fits = True
        while True:
            joined = rank(a + b, NEVER)
            if joined < until_a and joined <= until_b and joined != NEVER:
                fits = False
                break
            if len(a) > 1 and (len(b) == 1 or of_a > of_b):
                a, until_a = self.split(a)[1], of_a
                of_a = rank(a)
            elif len(b) > 1:
                b, until_b = self.split(b)[0], of_b
                of_b = rank(b)
            else:
                break
        self.pairs[key] = fits
        return fits

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after one more byte, and the tokens that are certain now."""
        live = []
        for held, last, node in self.states[state]:
            node = self.child.get(node << 8 | byte)
            if node is not None:
                live.append((held, last, node))
                token = self.token[node]
                if token >= 0 and self.compatible(last, token):
                    live.append(((*held, token), token, 0))
        shared = 0
        first, shortest = live[0][0], min(len(x[0]) for x in live)
        while shared < shortest and all(x[0][shared] == first[shared] for x in live):
            shared += 1
        if shared:
            live = [(held[shared:], last, node) for held, last, node in live]
        return self.number(tuple(live)), first[:shared]

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(self.steps) >= self.max_steps:
            self.reset()
        ids: list[int] = []
        state, steps = self.start, self.steps
        for byte in piece:
            key = state << 8 | byte
            found = steps.get(key)
            if found is None:
                found = steps[key] = self.step(state, byte)
            state, out = found
            if out:
                ids.extend(out)
        ids.extend(next((held for held, _, node in self.states[state] if not node), ()))
        return ids


class Pieces(dict):
    """Piece of text -> its ids as little-endian bytes."""

    def __init__(self, machine: Transducer, limit: int = MAX_PIECES):
        super().__init__()
        self.machine, self.limit = machine, limit

    def __missing__(self, piece: str) -> bytes:
        value = np.array(self.machine.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = value
        return value


class Utf8Machine:
    """Incremental UTF-8: its state is the bytes of the character that has begun but not ended."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character and lack its rest."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:  # not a continuation: the last character begins here
                need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
                return back if back < need else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.machine = Transducer(load_ranks(path))
        self.pieces = Pieces(self.machine)
        self.split = regex.compile(pattern).findall
        self.bytes_of = self.machine.bytes_of

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), "<u4")

    def decode_stream(self, ids: np.ndarray, chunk: int = CHUNK) -> Iterator[str]:
        utf8 = Utf8Machine()
        for k in range(0, len(ids), chunk):
            yield utf8.feed(b"".join(map(self.bytes_of.__getitem__, ids[k: k + chunk].tolist())))
        yield utf8.close()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One per process: its tables grow with what the process has read."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, keep: str = "doc_id", text: str = "text") -> DataFrame:
    """`keep` and the token ids (array of long) of every text."""
    frame = docs.select(keep, valid(text).alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            ids = [own.encode(t or "").astype(np.int64) for t in b.column(1).to_pylist()]
            schema = pa.schema([b.schema.field(0), ("ids", pa.list_(pa.int64()))])
            yield batch(schema, b.column(0), pa.array(ids, pa.list_(pa.int64())))

    return map_batches(frame, task, f"`{keep}` {frame.schema[0].dataType.simpleString()}, ids array<long>")


def decoded(tokens: DataFrame, path: str, pattern: str, keep: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`keep` and the text of every id list; ids outside the vocabulary fail."""
    frame = tokens.select(keep, F.col(ids).alias("_ids"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            texts = ["".join(own.decode_stream(np.array(x or [], np.int64))) for x in b.column(1).to_pylist()]
            yield batch(pa.schema([b.schema.field(0), ("text", pa.string())]), b.column(0), texts)

    return map_batches(frame, task, f"`{keep}` {frame.schema[0].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, keep: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the ids and of the bytes they decode to, per document; ids and text never leave the task."""
    frame = docs.select(keep, valid(text).alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            n, of_ids, of_bytes = [], [], []
            for t in b.column(1).to_pylist():
                ids = own.encode(t or "")
                digest = hashlib.sha256()
                for piece in own.decode_stream(ids):
                    digest.update(piece.encode())
                n.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_bytes.append(digest.hexdigest())
            yield batch(pa.schema([b.schema.field(0), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                                   ("decoded_sha256", pa.string())]), b.column(0), n, of_ids, of_bytes)

    kind = frame.schema[0].dataType.simpleString()
    return map_batches(frame, task, f"`{keep}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
