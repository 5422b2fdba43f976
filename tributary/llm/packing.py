"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens.  What is packed is the histogram of piece
lengths (at most ``capacity`` entries, however large the corpus): a bitset subset-sum over the
available lengths finds the fullest combination beside the largest piece left, and that combination
is removed as often as the histogram allows.  Pieces then take their places by their rank among
those of the same length; ranks are counted in salted groups of a bounded size, so a hot length is many small sorts.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.bpe import ASCII_PATTERN, PIECES_KEPT
from tributary.llm.common import cut

CAPACITY = 2048
END_ID = 0
RANKED_TOGETHER = 1_024  # pieces of a length whose ranks one sort gives, about


class FileEncoder(dict):
    """Ids by a byte-level BPE tokenizer file; as a dict, pre-token -> its ids as bytes (a bounded memory).

    As in the tokenizers library, a text is first split at the file's added tokens (the longest at a place),
    which get their own ids; what lies between is encoded by itself.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.model = parts["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in parts.get("added_tokens") or [] if t["content"]}
        if any(t.get(k) for t in parts.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on their surroundings are not read")
        self._build()

    def __reduce__(self):
        return _restored, (self.model, self.added)

    def _build(self) -> None:
        import re

        import public_tokenizers
        import regex
        import tiktoken

        # The file writes each byte as a printable character: the printable ones as themselves,
        # the others as the code points from 256 on, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in word): i for word, i in self.model.items() if all(c in byte_of for c in word)}
        ranks = {w: i for w, i in ranks.items() if w.decode("utf-8", "replace") not in self.added}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        white = public_tokenizers.PATTERN.replace(r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}")
        self.find, self.find_ascii = regex.compile(white).findall, re.compile(ASCII_PATTERN).findall
        self.whole = {w.decode("utf-8"): i.to_bytes(4, "little") for w, i in ranks.items() if _is_text(w)}
        self.merge = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={}).encode_ordinary

    def __missing__(self, token: str) -> bytes:
        ids = self.whole.get(token)
        if ids is None:
            ids = b"".join(i.to_bytes(4, "little") for i in self.merge(token))
        if len(token) <= 64:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[token] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not any(t in text for t in self.added):
            return self._plain(text)
        # at the odd places stand the added tokens
        return b"".join(self.added[x].to_bytes(4, "little") if k % 2 else self._plain(x) for k, x in enumerate(self.split(text)))

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, (self.find_ascii if text.isascii() else self.find)(text)))


def _restored(model, added):
    encoder = FileEncoder.__new__(FileEncoder)
    encoder.model, encoder.added = model, added
    encoder._build()
    return encoder


def _is_text(word: bytes) -> bool:
    try:
        word.decode("utf-8")
        return True
    except UnicodeDecodeError:
        return False


def broadcast_encoder(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(FileEncoder(path))


def pieces(docs: DataFrame, encoder, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document, its end id included.

    A null text is an empty one: a piece of the end id alone.  A longer document is cut from its end
    into pieces of ``capacity``, so only its first piece may be shorter.  Extra columns are left out.
    """
    end = end_id.to_bytes(4, "little")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = own.encode(text or "") + end
                    n, at, k = len(ids) // 4, 0, 0
                    while at < n:
                        size = (n - 1) % capacity + 1 if k == 0 else capacity
                        cut_out = ids[4 * at:4 * (at + size)]
                        rows.append((doc_id, k, at, size, zlib.crc32(cut_out), cut_out if keep_ids else None))
                        at, k = at + size, k + 1
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        task, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if keep_ids else out.drop("ids")


def fullest(available: Counter, room: int) -> list[int]:
    """Lengths, each at most as often as available, whose sum is the largest that fits in ``room``."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x, n in available.items() if n and x <= room), reverse=True):
        for _ in range(min(available[length], room // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> target & 1:
            chosen.append(length)
            target -= length
    return chosen


def combinations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many sequences each fills; together they use up the histogram."""
    left, out = Counter({k: n for k, n in histogram.items() if n}), []
    while left:
        largest = max(left)
        left[largest] -= 1
        combination = [largest, *fullest(left, capacity - largest)]
        left[largest] += 1
        uses = Counter(combination)
        times = min(left[x] // n for x, n in uses.items())
        for x, n in uses.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        out.append((combination, times))
    return out


def _places(filled: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length, for its pieces by rank: where each range of ranks begins, its first sequence, its offset."""
    taken: Counter = Counter()
    table: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for combination, times in filled:
        offset = 0
        for length in combination:
            table.setdefault(length, []).append((taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in table.items()}


def ranked(cut_pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Adds ``rank``: 0, 1, ... among the pieces of a length, counted in groups of about ``RANKED_TOGETHER`` pieces.

    ``histogram``: the number of pieces of every length.
    """
    groups_of = [max(1, -(-histogram.get(n, 0) // RANKED_TOGETHER)) for n in range(1, max(histogram, default=1) + 1)]
    salts = F.element_at(F.array(*map(F.lit, groups_of)), F.col("length").cast("int"))
    salted = cut_pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), salts).cast("long"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (salted.withColumn("rank", F.row_number().over(within) - 1).join(groups, ["length", "salt"])
            .withColumn("rank", F.col("rank") + F.col("first")).drop("salt", "first"))


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces; in a sequence they lie one after another from 0.

    ``cut_pieces`` must be stored (``common.cut``), since it is read for the histogram and for the
    ranks.  Repeated rows are pieces of their own.  An empty table gives none.
    """
    spark = cut_pieces.sparkSession
    histogram = {r[0]: r[1] for r in cut_pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    places = spark.sparkContext.broadcast(_places(combinations(histogram, capacity)))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = places.value
        for rows in batches:
            sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            lengths, ranks = rows["length"].to_numpy(), rows["rank"].to_numpy()
            for length in np.unique(lengths):
                here = np.flatnonzero(lengths == length)
                first, base, at = table[int(length)]
                k = np.searchsorted(first, ranks[here], "right") - 1
                sequence[here], offset[here] = base[k] + ranks[here] - first[k], at[k]
            yield rows.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked(cut_pieces, histogram).select(*columns, "rank").mapInPandas(
        task, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, encoder, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Places of the pieces of all documents (see ``pieces`` and ``pack``)."""
    return pack(cut(pieces(docs, encoder, capacity, end_id), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, encoder, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(sequence_id, ids): the packed sequences; a sequence holds ``capacity`` tokens at most."""
    own = pieces(docs, encoder, capacity, end_id, keep_ids=True).dropDuplicates(["doc_id", "piece", "ids_crc32"])
    parts = placed.join(own.select("doc_id", "piece", "ids_crc32", "ids"), ["doc_id", "piece", "ids_crc32"])
    return (parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.expr("aggregate(transform(parts, p -> hex(p.ids)), '', (a, x) -> concat(a, x))").alias("h"))
            .select("sequence_id", F.unhex("h").alias("ids")))
