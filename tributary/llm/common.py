"""Helpers that the text operators share: cutting lineage, words, grouped streams of rows."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import checkpoint_root

# Words are runs of anything but ASCII white space, which is what bytes.split() cuts at.
WORD_HASHES_KEPT = 400_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"llm-{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps, and retries after a lost
    executor, start from the files and not from the steps before."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class WordHashes(dict):
    """64-bit hash of each word, kept for words seen lately (at most ``WORD_HASHES_KEPT``)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_HASHES_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finisher of 64-bit hashes (the usual xor-shift-multiply constants)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = np.uint64(0x9E3779B97F4A7C15)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words; the whole sequence as one if it is shorter; none if empty."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out *= BASE
        out += words[k: len(words) - n + 1 + k]
    return mix(out + np.uint64(n))


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The rows of each key as arrays, from batches sorted by ``keys`` (integer columns).  Holds one key at a time."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        columns = {c: batch[c].to_numpy() for c in batch.columns}
        new = np.zeros(len(batch) - 1, bool)
        for k in keys:
            new |= columns[k][1:] != columns[k][:-1]
        at = [0, *(np.flatnonzero(new) + 1).tolist()]
        for lo, hi in zip(at, at[1:]):
            yield {c: v[lo:hi] for c, v in columns.items()}
        rest = batch.iloc[at[-1]:]
    if rest is not None:
        yield {c: rest[c].to_numpy() for c in rest.columns}


def map_runs(df: DataFrame, keys: list[str], each: Callable[[dict[str, np.ndarray]], pd.DataFrame | None],
             schema: str, partitions: int | None = None) -> DataFrame:
    """``each`` over the rows of every key, streamed through sorted partitions.  With ``partitions`` the single key
    is the partition's number (0 to ``partitions`` - 1) itself, so that no task gets two keys."""

    def task(batches):
        held, rows = [], 0
        for run in runs(batches, keys):
            out = each(run)
            if out is not None and len(out):
                held.append(out)
                rows += len(out)
                if rows > 10_000:
                    yield pd.concat(held, ignore_index=True)
                    held, rows = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    dealt = df.repartition(*keys) if partitions is None else df.repartitionById(partitions, keys[0])
    return dealt.sortWithinPartitions(*keys).mapInPandas(task, schema)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Union-find over ``n`` members: the smallest index that each is linked to."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(left.tolist(), right.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.fromiter((find(x) for x in range(n)), np.int64, n)


def digest(column) -> list:
    """Two independent 64-bit hashes of a text: equal texts, and in practice only those, agree."""
    return [F.xxhash64(F.lit(17), column).alias("d1"), F.xxhash64(F.lit(92821), column).alias("d2")]
