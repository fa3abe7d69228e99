"""Byte-level BPE encoding and decoding.

Two tiers: a minimal perfect hash over the vocabulary resolves every pre-token that is a
vocabulary entry as a whole; the others are merged with a heap over linked bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.pretokens import Generations, pretokens


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary of a rank file, in rank order.  Read on the driver: it is small and
    fixed, and travels to the tasks with the function."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranked = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranked[i] for i in range(len(ranked))]


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: n keys, n slots, one probe.

    Keys fall into buckets; the fullest buckets first look for a displacement that sends
    all their keys to free slots, single keys then take the slots that are left, whose
    number is stored as a negative displacement.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n * 3 // 5)
        filled: dict[int, list[tuple[int, int]]] = {}
        for i, key in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(key)
            filled.setdefault(h % self.buckets, []).append((h, i))
        self.shift = [0] * self.buckets
        self.slot = [-1] * self.n
        order = sorted(filled.items(), key=lambda x: (-len(x[1]), x[0]))
        free = None
        for bucket, members in order:
            if len(members) == 1:
                if free is None:
                    free = [s for s in range(self.n) if self.slot[s] < 0]
                at = free.pop()
                self.shift[bucket] = -1 - at
                self.slot[at] = members[0][1]
                continue
            d = 1
            while True:
                at = [self._place(h, d) for h, _ in members]
                if len(set(at)) == len(at) and all(self.slot[s] < 0 for s in at):
                    break
                d += 1
            self.shift[bucket] = d
            for s, (_, i) in zip(at, members):
                self.slot[s] = i
        self.keys = keys

    def _place(self, h: int, d: int) -> int:
        return ((h ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) % self.n

    def get(self, key: bytes) -> int:
        """Number of the key, -1 if it is none of the keys."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        i = self.slot[self._place(h, d) if d >= 0 else -1 - d]
        return i if i >= 0 and self.keys[i] == key else -1


class Codec:
    """Encoder and decoder of one vocabulary (list of byte strings in rank order)."""

    def __init__(self, vocabulary: list[bytes], memo_size: int = 250_000):
        self.vocabulary = vocabulary
        self.whole = PerfectHash(vocabulary)
        self.ranks = {token: i for i, token in enumerate(vocabulary)}
        self.memo = _Pieces(self, memo_size)

    def merged(self, piece: bytes) -> list[int]:
        """Merge by rank, leftmost first on ties: a heap of candidate pairs over a linked
        list of byte positions; outdated heap entries are recognised by their right end."""
        rank_of, n = self.ranks.get, len(piece)
        # a heap entry packs (rank, left start, right end); 24 bits hold a position unless
        # the piece is longer
        bits = 24 if n < 1 << 24 else n.bit_length()
        mask = (1 << bits) - 1
        after = list(range(1, n + 2))  # start of the next part, 0 where merged away
        before = list(range(-1, n))
        heap = [
            (rank << bits | i) << bits | i + 2
            for i in range(n - 1)
            if (rank := rank_of(piece[i : i + 2])) is not None
        ]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            end, left = entry & mask, entry >> bits & mask
            right = after[left]
            if not right or right >= n or after[right] != end:
                continue
            after[right], after[left] = 0, end
            if end < n:
                before[end] = left
                rank = rank_of(piece[left : after[end]])
                if rank is not None:
                    push(heap, (rank << bits | left) << bits | after[end])
            first = before[left]
            if first >= 0:
                rank = rank_of(piece[first:end])
                if rank is not None:
                    push(heap, (rank << bits | first) << bits | end)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def piece(self, piece: bytes) -> list[int]:
        found = self.whole.get(piece)
        return [found] if found >= 0 else self.merged(piece)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, pretokens(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Pieces(Generations):
    def __init__(self, codec: Codec, size: int):
        super().__init__(size)
        self.codec = codec

    def compute(self, token: str) -> bytes:
        ids = self.codec.piece(token.encode())
        return struct.pack(f"<{len(ids)}I", *ids)


_CODECS: dict[bytes, Codec] = {}


def codec_of(blob: bytes) -> Codec:
    """One codec per worker process and vocabulary; ``blob`` is newline-joined base64."""
    digest = hashlib.sha256(blob).digest()
    if digest not in _CODECS:
        _CODECS[digest] = Codec([base64.b64decode(x) for x in blob.split(b"\n")])
    return _CODECS[digest]


def _blob(path: str) -> bytes:
    return b"\n".join(base64.b64encode(token) for token in read_ranks(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text (null: empty): (id, n_tokens long, ids binary, decoded binary).

    ``ids`` packs little-endian unsigned 32-bit integers; ``decoded`` is the round trip
    through the decoder.  Other columns of ``docs`` are not carried, so their names do not
    matter; repeated rows give repeated results, an empty table an empty one.  One map over
    the rows, no shuffle; memory is one text plus a memo of bounded size.
    """
    blob = _blob(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(blob)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [codec.encode(text or "") for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([codec.decode(x) for x in ids], pa.binary()),
                    ],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """The digest columns of ``encode``."""
    return encode(docs, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
