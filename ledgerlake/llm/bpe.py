"""Byte-level BPE encoding and decoding by backtracking over longest matches.

The vocabulary's tokens, their bytes read as Latin-1 characters, form an
Aho-Corasick automaton whose one pass over a piece lists the longest token at
every byte. The encoder takes the longest token, and when it can't stand after
the token before it (the merges would have joined the bytes otherwise) falls
back to the next shorter prefix token, or steps back one token and marks the
position as a dead end. Whether two tokens may be adjacent is decided from the
merge that made each of them and memoised. Every position is tried a bounded
number of times, so the work is linear, and the ids equal those of merging the
lowest rank first.

Defined cases: null and empty texts have no ids and decode to no bytes.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = 48            # documents that a task holds encoded at once
PIECES = 150_000     # encoded pieces that a worker remembers (frequent ones come early)
PAIRS = 300_000      # remembered adjacency decisions


class Codec:
    """Encoder and decoder of one vocabulary of ranked byte tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.split_text = regex.compile(pattern).findall
        self.machine = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.machine.add_word(t.decode("latin-1"), i)
        self.machine.make_automaton()
        self.shorter: dict[int, int] = {}  # the longest token that is a proper prefix
        for t, i in ranks.items():
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in ranks:
                    self.shorter[i] = ranks[t[:n]]
                    break
        self.parts = {i: (i, i) for t, i in ranks.items() if len(t) == 1}  # the two tokens that were merged
        self.joined: dict[tuple[int, int], int] = {}
        for t, i in sorted(ranks.items(), key=lambda x: x[1]):
            left = self.shorter.get(i)
            while left is not None:
                right = ranks.get(t[self.size[left]:])
                if right is not None and left < i and right < i and self._adjacent(left, right):
                    self.parts[i], self.joined[left, right] = (left, right), i
                    break
                left = self.shorter.get(left)
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, list[int]] = {}

    def _adjacent(self, a: int, b: int) -> bool:
        """Whether the merges leave a and b side by side: no merge across them comes before one that made them."""
        limit = float("inf")
        while True:
            if self.joined.get((a, b), limit) < limit:
                return False
            can_a, can_b = self.parts[a][0] != a, self.parts[b][0] != b
            if not (can_a or can_b):
                return True
            if can_a and (a > b or not can_b):     # undo the later merge; those on the left win ties
                limit, a = a, self.parts[a][1]
            else:
                limit, b = b + 1, self.parts[b][0]

    def adjacent(self, a: int, b: int) -> bool:
        pair = a << 32 | b
        known = self.pairs.get(pair)
        if known is None:
            known = self._adjacent(a, b)
            if len(self.pairs) < PAIRS:
                self.pairs[pair] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        n, size = len(data), self.size
        longest = [-1] * n
        for end, token in self.machine.iter(data):
            longest[end + 1 - size[token]] = token  # ends only grow, so the last one is the longest
        open_at, out, at = bytearray(b"\1") * (n + 1), [], 0
        token = longest[0]
        while at < n:
            end = at + size[token]
            if open_at[end] and (not out or self.adjacent(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif token in self.shorter:
                token = self.shorter[token]
            else:
                open_at[at] = 0
                token = out.pop()
                at -= size[token]
        return out

    def encode(self, text: str | None) -> list[int]:
        pieces, out = self.pieces, []
        for piece in self.split_text(text or ""):
            ids = pieces.get(piece)
            if ids is None:
                ids = self.encode_piece(piece)
                if len(piece) < 64 and len(pieces) < PIECES:
                    pieces[piece] = ids
            out += ids
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process; ``path`` is a rank file (base64 token, rank) installed on every machine."""
    with open(path, "rb") as f:
        return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


def _list_array(rows: list[list[int]]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.fromiter((x for r in rows for x in r), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None,
           ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``keep`` columns (default: all) and the token ids; with ``decoded``, also the bytes that the ids decode to."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (ids, decoded)]

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [c.encode(t) for t in part.column(len(keep)).to_pylist()]
                cols = [part.column(i) for i in range(len(keep))] + [_list_array(found)]
                if decoded:
                    cols.append(pa.array([c.decode(x) for x in found], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, ids, *([decoded] if decoded else [])])

    fields = [docs.schema[c] for c in keep] + [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(decoded, T.BinaryType())] if decoded else []
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns and the bytes that ``ids`` stand for (null: none)."""
    keep = [c for c in df.columns if c != decoded]

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [c.decode(x or []) for x in part.column(part.schema.get_field_index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=[*keep, decoded])

    return df.select(*keep).mapInArrow(run, T.StructType([*[df.schema[c] for c in keep], T.StructField(decoded, T.BinaryType())]))


def digests(encoded: DataFrame, keep: list[str], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """n_tokens, ids_sha256, decoded_sha256 from encoded documents."""
    return encoded.select(
        *keep, F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"))
