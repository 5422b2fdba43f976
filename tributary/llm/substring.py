"""Removal of repeated word passages, found by difference-cover anchors.

A passage is a window of ``WINDOW`` words.  Hashing the windows of a corpus at every position would
move it several times over; instead, short anchors are hashed only at positions that lie in a
difference cover modulo ``PERIOD``.  For any two positions the cover has a shift below the period
that brings both into it, so two equal windows (PERIOD - 1 words longer than an anchor) share an
aligned anchor.  A first exchange tells every block of documents which of its anchors occur
elsewhere; each such anchor is extended to the windows around it, and only those windows go through
a second exchange, which tells whether the same words start earlier.

What is exchanged are arrays of distinct hashes, one row for a block and a target: a passage that a
third of all documents share is sent once by each block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import BASE, WordHashes, cut, digest, map_runs, mix

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)  # every difference modulo 13 is one of two members of the cover
ANCHOR = WINDOW - PERIOD + 1
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 2_000  # documents of a block at most
BLOCK_BYTES = 8 << 20  # text of a block, up to the document that passes it
TARGET_BYTES = 16 << 20  # text whose hashes meet in one target of the exchange
BASE_2 = np.uint64(0xD6E8FEB86659FD93)


def _combine(words: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Hash of the n words from every position on (positions with n words left)."""
    power, have, out = base, 1, words
    parts = []
    size = n
    while size:
        if size & 1:
            parts.append((have, out, power))
        size >>= 1
        if size:
            out = out[: len(out) - have] * power + out[have:] if len(out) > have else out[:0]
            power, have = power * power, have * 2
    total, taken = None, 0
    for have, out, power in parts:
        usable = len(words) - n + 1
        piece = out[taken: taken + usable]
        total = piece if total is None else total * power + piece
        taken += have
    return total


def window_hashes(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every n consecutive words."""
    if len(words) < n:
        return words[:0], words[:0]
    with np.errstate(over="ignore"):
        return mix(_combine(words, n, BASE)), mix(_combine(mix(words), n, BASE_2) + np.uint64(1))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of documents, some megabytes of text at a time."""
    rows, size = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            for row in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns)):
                rows.append(row)
                size += len(row[2])
                if len(rows) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    yield rows
                    rows, size = [], 0
    if rows:
        yield rows


def _deal(hashes: np.ndarray, targets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts by target, and where each target begins in it."""
    target = (hashes % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    return order, np.searchsorted(target[order], np.arange(targets + 1))


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a document's anchors; none if it is shorter than a window."""
    if len(words) < WINDOW:
        return np.zeros(0, np.int64), words[:0]
    at = np.arange(len(words) - ANCHOR + 1)
    at = at[np.isin(at % PERIOD, COVER)]
    return at, window_hashes(words, ANCHOR)[0][at]


def windows_around(flagged: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the windows that hold one of these anchors at a shift below the period."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, np.maximum(flagged - PERIOD + 1, 0), 1)
    np.add.at(steps, flagged + 1, -1)
    starts = np.flatnonzero(np.cumsum(steps)[:n_words] > 0)
    return starts[starts <= n_words - WINDOW]


MESSAGE = "kind int, target int, block long, names binary, h1 binary, h2 binary, docs binary, ats binary"
REQUEST, FLAGS = 0, 1


class _Messages:
    """Rows of ``MESSAGE`` collected for one output batch."""

    def __init__(self):
        self.rows: dict[str, list] = {x.split()[0]: [] for x in MESSAGE.split(", ")}

    def add(self, kind, target, block, names, doc, at, h1=None, h2=None):
        used, local = np.unique(doc, return_inverse=True)
        values = (kind, target, block, names[used].tobytes(), b"" if h1 is None else h1.tobytes(),
                  b"" if h2 is None else h2.tobytes(), local.astype(np.uint32).tobytes(), at.astype(np.uint32).tobytes())
        for column, value in zip(self.rows.values(), values):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        kinds = [types[x.split()[1]] for x in MESSAGE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self.rows.values(), kinds)], names=list(self.rows))


def _ask(out: _Messages, block: int, names: np.ndarray, doc: np.ndarray, at: np.ndarray, h1: np.ndarray,
         h2: np.ndarray | None, targets: int, first_only: bool) -> None:
    """Sends the first place of every distinct hash of a block to the hash's target.  What the block can
    tell by itself is flagged at once: any hash with two places (or its later places, if first_only)."""
    if not len(h1):
        return
    key, start = names[doc, 0], at
    order = np.lexsort((start, key, h1) if h2 is None else (start, key, h2, h1))
    same = h1[order][1:] == h1[order][:-1]
    if h2 is not None:
        same &= h2[order][1:] == h2[order][:-1]
    head = np.flatnonzero(np.concatenate([[True], ~same]))
    group = np.cumsum(np.concatenate([[0], ~same]))
    size = np.diff(np.append(head, len(order)))
    if first_only:  # rows of one document at one place are one place
        lead = order[head][group]
        known = order[(key[order] != key[lead]) | (start[order] != start[lead])]
    else:
        known = order[size[group] > 1]
    if len(known):
        out.add(FLAGS, int(block % targets), block, names, doc[known], at[known])
    first = order[head]
    by_target, begin = _deal(h1[first], targets)
    for t in range(targets):
        mine = first[by_target[begin[t]: begin[t + 1]]]
        if len(mine):
            short = (h1[mine] // np.uint64(targets)).astype(np.uint32) if h2 is None else h1[mine]
            out.add(REQUEST, t, block, names, doc[mine], at[mine], short,
                    None if h2 is None else (h2[mine] >> np.uint64(32)).astype(np.uint32))


def _send(targets: int, windows: bool):
    """Documents (k, d1, text[, ats]) -> messages about their anchors, or about the windows around the given anchors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows in _blocks(batches):
            names = np.array([r[:2] for r in rows], np.int64)
            block = xxhash.xxh3_64_intdigest(names.tobytes()) >> 1
            doc, at, h1, h2 = [], [], [], []
            for i, row in enumerate(rows):
                words = hashes.array(row[2].encode("utf-8").split())
                if windows:
                    starts = windows_around(np.frombuffer(row[3], np.uint32).astype(np.int64), len(words))
                    a, b = window_hashes(words, WINDOW)
                    h1.append(a[starts])
                    h2.append(b[starts])
                else:
                    starts, a = anchors(words)
                    h1.append(a)
                at.append(starts)
                doc.append(np.full(len(starts), i))
            out = _Messages()
            _ask(out, block, names, np.concatenate(doc), np.concatenate(at), np.concatenate(h1),
                 np.concatenate(h2) if windows else None, targets, windows)
            yield out.batch()

    return task


def _answer(windows: bool):
    """All requests to one target -> flags for their blocks."""

    def each(run: dict[str, np.ndarray]) -> pd.DataFrame | None:
        rows = np.flatnonzero(run["kind"] == REQUEST)
        passed = np.flatnonzero(run["kind"] == FLAGS)
        out = _Messages()
        for i in passed:
            for name, column in out.rows.items():
                column.append(run[name][i])
        if len(rows):
            names = [np.frombuffer(run["names"][i], np.int64).reshape(-1, 2) for i in rows]
            docs = [np.frombuffer(run["docs"][i], np.uint32) for i in rows]
            ats = [np.frombuffer(run["ats"][i], np.uint32) for i in rows]
            h1 = np.concatenate([np.frombuffer(run["h1"][i], np.uint64 if windows else np.uint32) for i in rows])
            begin = np.cumsum([0, *map(len, ats)])
            if windows:
                h2 = np.concatenate([np.frombuffer(run["h2"][i], np.uint32) for i in rows])
                key = np.concatenate([n[d, 0] for n, d in zip(names, docs)])
                start = np.concatenate(ats)
                order = np.lexsort((start, key, h2, h1))
                new = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
                head = np.flatnonzero(np.concatenate([[True], new]))
                lead = order[head][np.cumsum(np.concatenate([[0], new]))]
                flag = np.zeros(len(h1), bool)
                flag[order] = (key[order] != key[lead]) | (start[order] != start[lead])
            else:
                _, which, times = np.unique(h1, return_inverse=True, return_counts=True)
                flag = times[which] > 1
            for j, i in enumerate(rows):
                mine = np.flatnonzero(flag[begin[j]: begin[j + 1]])
                if len(mine):
                    out.add(FLAGS, 0, int(run["block"][i]), names[j], docs[j][mine], ats[j][mine])
        return pd.DataFrame(out.rows) if out.rows["kind"] else None

    return each


def _by_document(run: dict[str, np.ndarray]) -> pd.DataFrame:
    """All flags of a block -> (k, d1, ats) of its documents."""
    names = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in run["names"]]
    docs = [np.frombuffer(x, np.uint32) for x in run["docs"]]
    pairs, which = np.unique(np.concatenate([n[d] for n, d in zip(names, docs)]), axis=0, return_inverse=True)
    ats = np.concatenate([np.frombuffer(x, np.uint32) for x in run["ats"]])
    order = np.lexsort((ats, which.reshape(-1)))
    begin = np.searchsorted(which.reshape(-1)[order], np.arange(len(pairs) + 1))
    own = [np.unique(ats[order[begin[i]: begin[i + 1]]]).tobytes() for i in range(len(pairs))]
    return pd.DataFrame({"k": pairs[:, 0], "d1": pairs[:, 1], "ats": own})


def _exchange(docs: DataFrame, windows: bool) -> DataFrame:
    """(k, d1, ats): the flagged places of documents.  A block in two parts (after a retry on other
    splits) only gives a document two rows, so rows are merged by document at the end."""
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    targets = max(1, -(-text_bytes // TARGET_BYTES))
    asked = docs.mapInArrow(_send(targets, windows), MESSAGE)
    answers = map_runs(asked, ["target"], _answer(windows), MESSAGE, partitions=targets)
    return map_runs(answers.select("block", "names", "docs", "ats"), ["block"], _by_document, "k long, d1 long, ats binary")


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    first = F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1))  # a null id counts as the last
    d1, d2 = digest(F.col(text))
    return docs.where(F.col(text).isNotNull()).select(first.alias("k"), d1, d2, F.col(text).alias("text"))


def kept_words(words: list[bytes], starts: np.ndarray) -> list[bytes]:
    """The words that no window from these starts covers."""
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    keep = np.cumsum(steps)[: len(words)] == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            texts, removed = [], []
            for text, starts in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                words = text.encode("utf-8").split()
                kept = kept_words(words, np.frombuffer(starts, np.uint32).astype(np.int64))
                texts.append(b" ".join(kept).decode("utf-8"))
                removed.append(len(words) - len(kept))
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(texts, pa.string()), pa.array(removed, pa.int64())],
                                             names=["k", "d1", "kept_text", "n_removed"])


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, d1, kept_text, n_removed) of every text from which words go; k is its id (the largest long for
    a null one) and d1 a hash of the text.

    A word goes if a window that covers it also starts earlier: in a smaller doc_id, or before in the
    same document.  Windows are judged on the input.  ``kept_text`` joins the words that stay with one
    space.  Rows of one doc_id are one document: a repeated row does not repeat itself.  A
    text equal to one of a smaller doc_id goes whole if it has a window; it skips the exchange, and its
    kept_text is null with n_removed null (all words).  Null, empty and short texts have no window.
    """
    keyed = _keyed(docs, key, text)
    names = cut(keyed.select("k", "d1", "d2"), "names")
    first = names.groupBy("d1", "d2").agg(F.min("k").alias("first"), F.max("k").alias("last")).where("last > first")
    copies = cut(names.join(first, ["d1", "d2"]).where("k > first").select("k", "d1").distinct(), "copies")
    flagged = _exchange(keyed.select("k", "d1", "text"), windows=False)
    wanted = cut(flagged.join(copies, ["k", "d1"], "left_anti"), "anchors")
    held = cut(keyed.select("k", "d1", "text").join(wanted.hint("merge"), ["k", "d1"]).select("k", "d1", "text", "ats"), "candidates")
    starts = cut(_exchange(held, windows=True), "windows")
    found = held.select("k", "d1", "text").join(starts.hint("merge"), ["k", "d1"]).mapInArrow(
        _strip, "k long, d1 long, kept_text string, n_removed long")
    return found.dropDuplicates(["k", "d1"]).unionByName(copies.select(
        "k", "d1", F.lit(None).cast("string").alias("kept_text"), F.lit(None).cast("long").alias("n_removed")))


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [(t.as_py() or "").encode("utf-8").split() for t in batch.column(3)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([len(w) for w in words], pa.int64()),
             pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())],
            names=["doc_id", "k", "d1", "n_words", "whole_sha256"])


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def removal_digests(docs: DataFrame) -> DataFrame:
    """Per document: its words, how many go, and the SHA-256 of the words that stay joined by one space."""
    found = repeated_passages(docs).select("k", "d1", "n_removed", F.sha2("kept_text", 256).alias("sha"), F.lit(True).alias("hit"))
    first = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("k")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), first, digest(F.col("text"))[0], "text").mapInArrow(
        _plain, "doc_id long, k long, d1 long, n_words long, whole_sha256 string")
    whole_copy = F.col("hit") & F.col("n_removed").isNull()
    gone = F.when(whole_copy & (F.col("n_words") >= WINDOW), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    sha = (F.when(whole_copy & (F.col("n_words") >= WINDOW), F.lit(EMPTY_SHA256))
           .otherwise(F.coalesce("sha", "whole_sha256")))
    return rows.join(found.hint("merge"), ["k", "d1"], "left").select("doc_id", "n_words", gone.alias("n_removed"), sha.alias("kept_sha256"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without their repeated passages; a row that loses all its words goes.

    Texts without a repeated passage stay as they are, white space included.
    """
    found = repeated_passages(docs, key, text).select("k", "d1", "kept_text", F.lit(True).alias("hit"))
    found = found.select(F.struct("k", "d1").alias("__at"), F.struct("kept_text", "hit").alias("__found"))
    place = F.struct(F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)).alias("k"), digest(F.col(text))[0])
    rows = docs.withColumn("__at", place).join(found, "__at", "left")
    # a text shorter than a window that equals an earlier one loses nothing
    long_enough = F.size(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))) >= WINDOW
    copy = F.col("__found.hit") & F.col("__found.kept_text").isNull()
    new = F.when(copy & long_enough, F.lit("")).otherwise(F.coalesce("__found.kept_text", F.col(text)))
    kept = rows.withColumn(text, new).where(~(F.coalesce(F.col("__found.hit"), F.lit(False)) & (F.col(text) == "")))
    return kept.select(*[c for c in docs.columns])
