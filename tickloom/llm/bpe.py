"""Byte-level BPE by prefix dynamic programming.

Every byte prefix of a piece has exactly one last token in its encoding: the longest-reaching token
that ends there and may follow the last token of the prefix before it. A table of those last tokens
encodes the piece by walking back from its end, takes further bytes without touching what it has, and
after an edit is filled again only until it agrees with the old table over the length of the longest
token. As the last tokens depend on the bytes of the prefix alone, the tables of short prefixes are
shared: a word is worked out only from where it leaves the beginnings seen before. Two tokens may stand side by side when no merge across their border would come before the
merges inside them; that is decided from the ranks alone and remembered.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import SLICE_BYTES, in_arrow, slices

# A rank file beyond this is not sent to the tasks.
RANKS_BYTES = 64 << 20

# Pieces, beginnings of pieces and token pairs that a worker remembers. Of the first two, what was not
# used while as many others came is forgotten; pairs are forgotten all at once and learned anew.
PIECES_KEPT = 3 << 16
BEGINNINGS_KEPT = 1 << 16
PAIRS_KEPT = 1 << 18
LONG_PIECE = 64
SHARED_BYTES = 8

_NEVER = 1 << 60
TOKEN = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (one base64 token and its rank a line)."""
    with open(path, "rb") as lines:
        raw = lines.read(RANKS_BYTES + 1)
    if len(raw) > RANKS_BYTES:
        raise ValueError(f"{path} has more than {RANKS_BYTES} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


class Vocabulary:
    """Ranks of tokens, and which of them may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in ranks.values()}
        self.longest = max(map(len, ranks), default=0)
        # Tokens read backwards, a branch per byte; the rank of a token stands under TOKEN.
        self.backwards: dict = {}
        for token, rank in ranks.items():
            node = self.backwards
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[TOKEN] = rank
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._spines: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}
        self._fits: dict[int, bool] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one last; None for single bytes.

        A token that no merges lead to has itself as first half.
        """
        if token not in self._halves:
            raw = self.tokens[token]
            parts = [raw[i : i + 1] for i in range(len(raw))]
            while len(parts) > 2:
                pairs = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
                best = min(pairs)
                if best == _NEVER:
                    break
                at = pairs.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(raw) == 1:
                self._halves[token] = None
            elif len(parts) == 2 and all(part in self.ranks for part in parts):
                self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]])
            else:
                self._halves[token] = (token, token)
        return self._halves[token]

    def reachable(self, token: int) -> bool:
        return self.halves(token) != (token, token)

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """Tokens that were at the left (0) or right (1) edge in turn: bytes, rank when made, rank when merged away."""
        key = (token, side)
        if key not in self._spines:
            out, end = [], _NEVER
            while True:
                own = self.halves(token)
                out.append((self.tokens[token], token if own else -1, end))
                if own is None or own == (token, token):
                    break
                token, end = own[side], token
            self._spines[key] = out
        return self._spines[key]

    def fit(self, left: int, right: int) -> bool:
        """Whether ``left right`` is the encoding of its own bytes."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= PAIRS_KEPT:
                self._fits.clear()
            known = self._fits[key] = self._decide(left, right)
        return known

    def last_token(self, raw: bytes, end: int, last: list[int]) -> int:
        """The last token of the first ``end`` bytes; ``last`` has those of all shorter prefixes."""
        node, found, start = self.backwards, [], end
        while start:
            start -= 1
            node = node.get(raw[start])
            if node is None:
                break
            if TOKEN in node:
                found.append((start, node[TOKEN]))
        known = self._fits.get
        for start, token in reversed(found):
            if not start:
                if self.reachable(token):
                    return token
                continue
            fits = known(last[start - 1] << 32 | token)
            if self.fit(last[start - 1], token) if fits is None else fits:
                return token
        raise ValueError(f"no token for byte {raw[end - 1]}")

    def _decide(self, left: int, right: int) -> bool:
        for a, made_a, end_a in self._spine(left, 1):
            for b, made_b, end_b in self._spine(right, 0):
                rank = self.ranks.get(a + b)
                if rank is None:
                    continue
                # The merge across can happen once both are there. Equal ranks merge from the left.
                when = max(rank, made_a, made_b)
                if when < end_a and when <= end_b:
                    return False
        return True


class PrefixTable:
    """Last tokens of all byte prefixes of a piece; ``last`` are those of a beginning, where known."""

    def __init__(self, vocabulary: Vocabulary, raw: bytes = b"", last: Sequence[int] = ()):
        self.vocabulary, self.raw, self.last = vocabulary, raw[: len(last)], list(last)
        self.append(raw[len(last) :])

    def append(self, more: bytes) -> PrefixTable:
        """Take further bytes; what is there stays as it is."""
        raw, last, last_token = self.raw + more, self.last, self.vocabulary.last_token
        for end in range(len(last) + 1, len(raw) + 1):
            last.append(last_token(raw, end, last))
        self.raw = raw
        return self

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes start..stop; returns how many prefixes were worked out again.

        The last token depends on as many prefixes as the longest token has bytes. Once that many in a row,
        all behind the edit, agree with the old table, the rest of the old table holds.
        """
        raw = self.raw[:start] + new + self.raw[stop:]
        shift = len(new) - (stop - start)
        last, agreed, end = self.last[:start], 0, start
        while end < len(raw):
            end += 1
            last.append(self.vocabulary.last_token(raw, end, last))
            before = end - shift
            if end - self.vocabulary.longest >= start + len(new) and last[-1] == self.last[before - 1]:
                agreed += 1
            else:
                agreed = 0
            if agreed >= self.vocabulary.longest:
                break
        worked = end - start
        self.raw, self.last = raw, last + self.last[end - shift :]
        return worked

    def tokens(self) -> list[int]:
        out, end = [], len(self.raw)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.tokens[token])
        return out[::-1]


class Recent(dict):
    """Remembers what a function gave. When it has ``size`` entries it starts afresh, next to the old ones;
    those go when it is full again, unless they were used in between."""

    def __init__(self, function: Callable, size: int):
        self.function, self.size, self.old = function, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}


class Encoder:
    """Encodes texts piece by piece; remembers short pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pieces = regex.compile(pattern).findall
        self._beginnings = Recent(self._beginning, BEGINNINGS_KEPT)
        self._printed = Recent(self._entry, PIECES_KEPT)

    def _beginning(self, raw: bytes) -> tuple[int, ...]:
        before = self._beginnings[raw[:-1]] if len(raw) > 1 else ()
        return (*before, self.vocabulary.last_token(raw, len(raw), before))

    def piece(self, raw: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(raw)
        if whole is not None:
            return [whole]
        return PrefixTable(self.vocabulary, raw, self._beginnings[raw[:SHARED_BYTES]]).tokens()

    def forget(self) -> None:
        """Give back the memory of pieces; what is known of token pairs stays."""
        self._beginnings.forget()
        self._printed.forget()

    def encode(self, text: str) -> list[int]:
        return [token for piece in self.pieces(text) for token in self.piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))

    def _entry(self, piece: str) -> tuple[int, str, bytes]:
        """Number of tokens, decimal ids, and the bytes that the ids decode to."""
        ids = self.piece(piece.encode())
        return len(ids), " ".join(map(self.vocabulary.names.__getitem__, ids)), self.decode(ids)

    def printed(self, text: str) -> tuple[int, str, bytes]:
        """Number of tokens, decimal ids joined by one space, decoded bytes."""
        pieces = self.pieces(text)
        if not pieces:
            return 0, "", b""
        if max(map(len, pieces)) > LONG_PIECE:  # too long to remember
            entries = [self._entry(piece) if len(piece) > LONG_PIECE else self._printed[piece] for piece in pieces]
        else:
            entries = map(self._printed.__getitem__, pieces)
        counts, ids, decoded = zip(*entries)
        return sum(counts), " ".join(ids), b"".join(decoded)


# The encoder in use, kept between the tasks of one worker.
_LAST: dict[str, Encoder] = {}


def _ready(key: str, ranks: Broadcast, pattern: str) -> Encoder:
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = Encoder(ranks.value, pattern)
    return _LAST[key]


def encode_texts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, token_ids.

    Each match of ``pattern`` is encoded by itself, without special tokens; the ids are then decoded.
    Null texts are empty and have no tokens. Rows are independent of each other and are not shuffled, so repeated
    ones agree; no rows give no rows. A text is held whole by its task; other columns are not looked at. The rank file is read here and sent to the tasks (bounded by
    ``RANKS_BYTES``).
    """
    context = docs.sparkSession.sparkContext
    sent, key = context.broadcast(read_ranks(ranks_path)), uuid.uuid4().hex
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _ready(key, sent, pattern)
        for batch in batches:
            for part, raws in slices(batch, "body", SLICE_BYTES // 4):
                counts, ids_sha, decoded_sha, token_ids = [], [], [], [np.empty(0, np.int32)]
                for raw in raws:
                    n, ids, decoded = own.printed(raw.decode())
                    counts.append(n)
                    ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                    decoded_sha.append(hashlib.sha256(decoded).hexdigest())
                    if keep_ids:
                        token_ids.append(np.array(ids.split(), np.int32))
                columns = [
                    part.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_sha, pa.string()),
                    pa.array(decoded_sha, pa.string()),
                ]
                if keep_ids:
                    ends = pa.array(np.cumsum([0, *counts]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(token_ids))))
                yield pa.RecordBatch.from_arrays(columns, names)
        own.forget()

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("body"))
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * keep_ids
    return in_arrow(rows, run, schema).withColumnRenamed("id", id_column)
