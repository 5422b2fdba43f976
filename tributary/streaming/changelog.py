"""A change log as a table on a stream (T10, D6): state per row, messages per change.

The batch form (``cdc.retract_stream``) trusts the before image of a change.  On a stream the row as it was last
told comes from state, so the messages always fold to the table, also where changes arrive out of order or a
before image is missing: a change that is older than the one the row stands at says nothing any more (each
image replaces the whole row) and makes no message.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MESSAGES = "tableName string, pk string, seq long, pos int, flag boolean, image string"


#: Parts into which the rows of a table are dealt.  A key costs far more than a change; a slot's state is read whole
#: when the slot gets changes.
SLOTS = 512


def row_messages(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Key: (table, slot of primary keys).  State: of each row the last change's sequence and image; a deleted row
    keeps its sequence with no image, so that an older change can't bring it back."""
    stood = {pk: (seq, image) for pk, seq, image in zip(*state.get)} if state.exists else {}
    moved = False
    for pdf in rows:
        out = []
        changes = zip(pdf["seq"].tolist(), pdf["pk"].tolist(), pdf["image"].tolist())
        for at, pk, new in sorted(changes, key=lambda change: change[0]):
            at, pk, new = int(at), pk if isinstance(pk, str) else None, new if isinstance(new, str) else None
            seq, image = stood.get(pk, (None, None))
            if seq is not None and at <= seq:
                continue
            told = [(False, image)] if image is not None else []
            told += [(True, new)] if new is not None else []
            out += [(key[0], pk, at, pos, flag, said) for pos, (flag, said) in enumerate(told)]
            stood[pk] = (at, new)
            moved = True
        if out:
            yield pd.DataFrame(out, columns=["tableName", "pk", "seq", "pos", "flag", "image"])
    if moved:
        state.update((list(stood), [seq for seq, _ in stood.values()], [image for _, image in stood.values()]))


def retract_messages(env: DataFrame, columns: list[str], key: str = "id", seq: str = "offset") -> DataFrame:
    """T10 on a stream of change envelopes: (seq, tableName, pk, pos, flag, columns...).

    An image becomes (true, row), after (false, old row) if there was one; a delete is (false, old row).  Of the
    changes of a row that come in one micro-batch each makes its messages; changes without a key, or of a table
    without a name, share a row of their own.
    """
    image = F.when(~F.col("type").eqNullSafe("delete"), F.to_json("after"))
    keyed = env.select("tableName", F.coalesce(F.col("after")[key], F.col("before")[key]).alias("pk"),
                       F.col(seq).alias("seq"), image.alias("image"))
    slot = F.pmod(F.xxhash64("pk"), F.lit(SLOTS)).cast("int").alias("slot")
    told = keyed.select("*", slot).groupBy("tableName", "slot").applyInPandasWithState(
        row_messages, MESSAGES, "pk array<string>, seq array<long>, image array<string>", "append", GroupStateTimeout.NoTimeout)
    row = F.from_json("image", "map<string,string>")
    return told.select("seq", "tableName", "pk", "pos", "flag", *(row[c].alias(c) for c in columns))


def fold(messages: DataFrame, columns: list[str]) -> DataFrame:
    """The table that retract messages describe: rows told once more than they were taken back.

    An aggregate over the whole row, combined before the shuffle; equal rows are counted, not merged.
    """
    n = F.sum(F.when(F.col("flag"), 1).otherwise(-1))
    left = messages.groupBy(*columns).agg(n.alias("n")).where("n > 0")
    return left.select(*columns, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k")).drop("k")
