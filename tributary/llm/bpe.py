"""Byte-level BPE: encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by the vocabulary's pattern.  A pre-token that is a vocabulary entry
is resolved at once by a minimal perfect hash; any other is merged pair by pair, lowest rank first,
with a heap over linked bytes.  Each Python worker remembers the pre-tokens it saw lately (a bounded
number), so the lookup runs about once per distinct pre-token.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECES_KEPT = 600_000
WHITE = r"\x09-\x0d "
# The public pattern over ASCII texts (there its classes are these ranges).
ASCII_PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^{WHITE}A-Za-z0-9]+"
                 rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


class MinimalPerfectHash:
    """Maps ``n`` known keys to the slots 0 to n-1 without gaps (hash and displace).

    Keys are dealt into ``n`` buckets; for each bucket of several keys, largest first, a seed is
    searched that sends them all to free slots; single keys get the slots left over directly.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        buckets: dict[int, list[bytes]] = {}
        for key in keys:
            buckets.setdefault(xxhash.xxh64_intdigest(key) % n, []).append(key)
        self.seeds = [0] * max(n, 1)
        free = [True] * n
        single = []
        for bucket, own in sorted(buckets.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:
                single.append(bucket)
                continue
            seed = 1
            while True:
                slots = {xxhash.xxh64_intdigest(key, seed) % n for key in own}
                if len(slots) == len(own) and all(free[s] for s in slots):
                    break
                seed += 1
            self.seeds[bucket] = seed
            for s in slots:
                free[s] = False
        left = iter([s for s in range(n) if free[s]])
        for bucket in single:
            self.seeds[bucket] = -next(left) - 1

    def slot(self, key: bytes) -> int:
        """The slot of a known key; any slot for others (compare with the key kept there)."""
        seed = self.seeds[xxhash.xxh64_intdigest(key) % self.n]
        return -seed - 1 if seed < 0 else xxhash.xxh64_intdigest(key, seed) % self.n


class BytePairCodec(dict):
    """Encoder and decoder for one vocabulary; as a dict, pre-token -> its ids as bytes (the memory)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern = ranks, pattern
        self.index = MinimalPerfectHash(list(ranks))
        self.slots: list = [None] * len(ranks)
        for key, rank in ranks.items():
            self.slots[self.index.slot(key)] = (key, rank.to_bytes(4, "little"))
        self.bytes_of = {rank: key for key, rank in ranks.items()}
        self._compile()

    def _compile(self) -> None:
        import re

        white = self.pattern.replace(r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}")
        self.find = regex.compile(white).findall
        import public_tokenizers

        self.find_ascii = re.compile(ASCII_PATTERN).findall if self.pattern == public_tokenizers.PATTERN else self.find

    def __reduce__(self):
        return _restore, (self.ranks, self.pattern, self.index, self.slots, self.bytes_of)

    def whole(self, piece: bytes) -> bytes | None:
        """First tier: the id of a pre-token that is in the vocabulary."""
        entry = self.slots[self.index.slot(piece)] if self.slots else None
        return entry[1] if entry and entry[0] == piece else None

    def merge(self, piece: bytes) -> list[int]:
        """Second tier: merge the linked bytes, the pair of the lowest rank (then the leftmost) first."""
        n, rank = len(piece), self.ranks.get
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, mid, end = heapq.heappop(heap)
            if after[i] != mid or mid >= n or after[mid] != end:
                continue  # one of the two parts has been merged meanwhile
            after[i], after[mid] = end, -1
            if end < n:
                before[end] = i
                if (r := rank(piece[i:after[end]])) is not None:
                    heapq.heappush(heap, (r, i, end, after[end]))
            if i:
                j = before[i]
                if (r := rank(piece[j:end])) is not None:
                    heapq.heappush(heap, (r, j, i, end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:after[i]]])
            i = after[i]
        return out

    def __missing__(self, token: str) -> bytes:
        piece = token.encode("utf-8")
        ids = self.whole(piece)
        if ids is None:
            ids = b"".join(i.to_bytes(4, "little") for i in self.merge(piece))
        if len(piece) <= 64:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[token] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        find = self.find_ascii if text.isascii() else self.find
        return b"".join(map(self.__getitem__, find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _restore(ranks, pattern, index, slots, bytes_of):
    codec = BytePairCodec.__new__(BytePairCodec)
    codec.ranks, codec.pattern, codec.index, codec.slots, codec.bytes_of = ranks, pattern, index, slots, bytes_of
    codec._compile()
    return codec


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def broadcast_codec(spark: SparkSession, path: str, pattern: str):
    """The vocabulary (its size is that of the file, whatever the corpus) for all executors."""
    return spark.sparkContext.broadcast(BytePairCodec(load_ranks(path), pattern))


def encode(docs: DataFrame, codec, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, n_tokens): the whole text of each row as ids (binary, little-endian unsigned 32 bit).

    A null text is an empty one and gives no ids.  Rows are handled one by one, so repeated rows and
    null keys come back as they are; other columns, whatever their names, are left out.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())],
                    names=[key, "ids", "n_tokens"])

    rows = docs.select(key, text)
    return rows.mapInArrow(task, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids binary, n_tokens long")


def decode(encoded: DataFrame, codec, key: str = "doc_id") -> DataFrame:
    """(key, ids, n_tokens, decoded): the bytes that the ids stand for.  Null ids give no bytes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [own.decode(x or b"") for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())],
                                                 names=[key, "ids", "n_tokens", "decoded"])

    rows = encoded.select(key, "ids", "n_tokens")
    return rows.mapInArrow(task, f"`{key}` {encoded.schema[key].dataType.simpleString()}, ids binary, "
                                 "n_tokens long, decoded binary")


def round_trip_digests(docs: DataFrame, codec) -> DataFrame:
    """Per document the token count and the SHA-256 of its ids and of the bytes decoded from them."""
    return decode(encode(docs, codec), codec).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
