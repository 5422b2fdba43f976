"""Harmonic packing: pieces of one class fill a sequence by a fixed count, each worker by itself.

A piece of ``length`` tokens is of class ``capacity // length``: class k holds the lengths above
capacity/(k+1) and up to capacity/k, and k of them always fit into one sequence.  Documents may be cut
freely, so they are cut at the top of the classes whose k is a power of two: as many whole sequences as
the document has, then pieces of capacity/2, capacity/4, ... as its rest needs.  k pieces of such a
class fill a sequence to its last token.

Every task fills the sequences of its own partition in one pass, with one open sequence a class; no
piece is shuffled.  What the open sequences hold at the end of a partition (fewer than two pieces a place of
the smallest class) is laid together, largest pieces first: since all lengths are powers of two, it fills whole
sequences and then, at most once a class, sequences whose length is a power of two, which need no padding.  All
pieces of a sequence come from one partition, so a task that is repeated gives the same whole sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
END_ID = 1
SEQUENCES_A_TASK = 2**33  # sequence ids of a partition begin at its number times this

PLACES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
SEQUENCES = "sequence_id long, n_tokens long, padded long, ids binary"


def is_power_of_two(n: int) -> bool:
    return n > 0 and not n & (n - 1)


def padded_length(n_tokens: int, capacity: int = CAPACITY) -> int:
    """What a sequence of ``n_tokens`` takes: its own length at a power of two, else ``capacity``."""
    return n_tokens if is_power_of_two(n_tokens) else capacity


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths into which a document of ``n`` tokens is cut, in its order: each the top of its class."""
    out = [capacity] * (n // capacity)
    rest, size = n % capacity, capacity
    while rest:
        size //= 2
        if rest >= size:
            out.append(size)
            rest -= size
    return out


class Classes:
    """The open sequence of every class; ``add`` gives a sequence back when its class's count is reached."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity, self.open = capacity, {}

    def add(self, length: int, piece) -> list | None:
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((length, piece))
        return self.open.pop(k) if len(held) == k else None

    def rest(self) -> Iterator[list]:
        """What is still open, as full sequences and then ones whose length is a power of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]  # the largest first
        total, at = sum(n for n, _ in left), 0
        self.open = {}
        while total:
            size = min(self.capacity, 1 << (total.bit_length() - 1))
            filled, out = 0, []
            while filled < size:  # descending powers of two meet every such bound
                filled += left[at][0]
                out.append(left[at])
                at += 1
            total -= size
            yield out


def _sequences(batches: Iterator[pa.RecordBatch], encoder, capacity: int, end_id: int) -> Iterator[tuple[int, list]]:
    """(sequence_id, [(length, (doc_id, start, ids, doc_tokens))]) of the sequences of one partition."""
    own, classes = encoder.value, Classes(capacity)
    end = end_id.to_bytes(4, "little")
    number = TaskContext.get().partitionId() * SEQUENCES_A_TASK
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            doc_id, ids = doc_id.as_py(), own.encode(text.as_py() or "") + end
            at, n = 0, len(ids) // 4
            for length in cuts(n, capacity):
                full = classes.add(length, (doc_id, at, ids[4 * at:4 * (at + length)], n))
                at += length
                if full:
                    yield number, full
                    number += 1
    for last in classes.rest():
        yield number, last
        number += 1


def _checked(docs: DataFrame, key: str, text: str, capacity: int) -> DataFrame:
    if not is_power_of_two(capacity):
        raise ValueError("the capacity must be a power of two")
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def pack_documents(docs: DataFrame, encoder, capacity: int = CAPACITY, end_id: int = END_ID,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    Each document is encoded whole and ends with ``end_id``.  A null text is an empty one: a piece of
    the end id alone.  Repeated rows, and rows without an id, are documents of their own; extra columns
    are left out; an empty table gives no pieces.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for sequence, members in _sequences(batches, encoder, capacity, end_id):
            offset = 0
            for length, (doc_id, start, ids, doc_tokens) in members:
                rows.append((doc_id, start, length, zlib.crc32(ids), doc_tokens, sequence, offset))
                offset += length
            if len(rows) > 5_000:
                yield _batch(rows, PLACES)
                rows = []
        if rows:
            yield _batch(rows, PLACES)

    return _checked(docs, key, text, capacity).mapInArrow(task, PLACES)


def packed_sequences(docs: DataFrame, encoder, capacity: int = CAPACITY, end_id: int = END_ID,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """(sequence_id, n_tokens, padded, ids): the sequences themselves, ids as little-endian 32-bit numbers;
    the same as ``pack_documents`` places them on the same table."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for sequence, members in _sequences(batches, encoder, capacity, end_id):
            n = sum(length for length, _ in members)
            rows.append((sequence, n, padded_length(n, capacity), b"".join(p[2] for _, p in members)))
            if len(rows) > 500:
                yield _batch(rows, SEQUENCES)
                rows = []
        if rows:
            yield _batch(rows, SEQUENCES)

    return _checked(docs, key, text, capacity).mapInArrow(task, SEQUENCES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    types = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])
