"""Byte-level BPE as a monoid: pieces are encoded by halves and joined at their boundary.

A sequence of tokens is the encoding of its bytes exactly when every two neighbours in it are
the encoding of their own bytes. So two encoded halves can be joined by re-encoding a window
around the boundary alone: once the window's first and last tokens are proven neighbours of
the tokens outside it, nothing outside can change. If a proof fails, the window doubles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

LEAF_BYTES = 16
CACHE_PIECES = 300_000
NO_RANK = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class BytePairCodec:
    """Encodes and decodes with a table of ranks; holds bounded caches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pieces = regex.compile(pattern)
        self.neighbours: dict[tuple[int, int], bool] = {}
        self.packed = _PackedPieces(self)

    def encode_leaf(self, data: bytes) -> list[int]:
        """Merge the neighbouring pair of lowest rank, the first on a tie, until none is left."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        get = ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        scores = [get(data[i : i + 2], NO_RANK) for i in range(len(data) - 1)]
        while scores:
            lowest = min(scores)
            if lowest == NO_RANK:
                break
            i = scores.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], NO_RANK)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
        return [ranks[p] for p in parts]

    def are_neighbours(self, left: int, right: int) -> bool:
        """Whether the two tokens are what their joint bytes encode to."""
        known = self.neighbours.get((left, right))
        if known is None:
            if len(self.neighbours) >= CACHE_PIECES:
                self.neighbours.clear()
            known = self.encode_leaf(self.tokens[left] + self.tokens[right]) == [left, right]
            self.neighbours[left, right] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the joint bytes of two encodings."""
        if not left or not right:
            return left or right
        if self.are_neighbours(left[-1], right[0]):
            return left + right
        width = 2
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.encode_leaf(b"".join(self.tokens[t] for t in left[a:] + right[:b]))
            begins = a == 0 or self.are_neighbours(left[a - 1], window[0])
            ends = b == len(right) or self.are_neighbours(window[-1], right[b])
            if begins and ends:
                return left[:a] + window + right[b:]
            width *= 2

    def encode_piece(self, data: bytes) -> list[int]:
        """Tree reduction: halves are encoded and joined, leaves are merged directly."""
        if len(data) <= LEAF_BYTES:
            return self.encode_leaf(data)
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        middle = len(data) // 2
        return self.join(self.encode_piece(data[:middle]), self.encode_piece(data[middle:]))

    def encode_packed(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.pieces.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int], leaf: int = 256) -> bytes:
        """Leaves of ``leaf`` tokens, then neighbours are concatenated up the tree."""
        take = self.tokens.__getitem__
        level = [b"".join(map(take, ids[i : i + leaf])) for i in range(0, len(ids), leaf)]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


class _PackedPieces(dict):
    """Packed ids per piece; emptied when it has grown to ``CACHE_PIECES``."""

    def __init__(self, codec: BytePairCodec):
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        ids = self.codec.encode_piece(data)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(data) <= 64:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = packed
        return packed


_CODECS: dict[tuple[str, str], BytePairCodec] = {}


def codec(path: str, pattern: str) -> BytePairCodec:
    """One codec per Python worker and rank file."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = BytePairCodec(load_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode_documents(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Token ids of every whole text, and digests of the ids and of the bytes decoded from them.

    Returns id, ``n_tokens``, ``ids`` (array, if ``with_ids``), ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers) and ``decoded_sha256``. No row leaves its partition.
    ``ranks_path`` is read by the workers and must be there on each of them.

    Defined cases: a null or empty text has no tokens; any id, null or repeated, is passed on; an
    empty table gives an empty table; only the two named columns are read.
    """
    id_type = documents.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, n_tokens bigint, " + "ids array<int>, " * with_ids
    schema += "ids_sha256 string, decoded_sha256 string"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(ranks_path, pattern)
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                counts, ids, digests, decoded = [], [], [], []
                for scalar in batch.column(1):
                    packed = tool.encode_packed(scalar.as_py() or "")
                    numbers = np.frombuffer(packed, dtype="<u4")
                    counts.append(len(numbers))
                    digests.append(hashlib.sha256(packed).hexdigest())
                    decoded.append(hashlib.sha256(tool.decode(numbers.tolist())).hexdigest())
                    if with_ids:
                        ids.append(numbers.astype(np.int32))
                columns = [batch.column(0), pa.array(counts, pa.int64())]
                names = [id_column, "n_tokens"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                columns += [pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids_sha256", "decoded_sha256"])

    return documents.select(id_column, text_column).mapInArrow(encoded, schema)
