"""Per-visitor state machines for streams (T1 new-visitor repair, T2 unique visits, T4 bounces).

The rules depend on the order of one visitor's events, which no built-in streaming
operator expresses, so they run as pandas functions over keyed state in the (RocksDB) state store.  The rows of one
key in one micro-batch arrive as pandas frames.  A key costs milliseconds whatever it holds, so a key is a slot
of visitors, judged visitor by visitor.  T1 and T2 need one value a key, which comes and goes with the rows
(``applyInPandasWithState``); T4 needs lists and an event-time timer (``transformWithStateInPandas``).
The batch forms in ``operators.logs`` / ``operators.visits`` compute the same results
without any per-visitor task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tributary.functions.timefmt import day_text, duration_ms, event_time
from tributary.operators.visits import is_entry_page
from tributary.schemas import BOUNCE_WITHIN, VISIT_STATE_TTL, WATERMARK_DELAY

NEW_FLAG_OUTPUT = "offset long, mid string, is_new string"
BOUNCE_OUTPUT = "offset long, mid string, ts long"
EVENT = ["mid", "ts", "offset", "entry"]
EVENT_SCHEMA = "mid string, ts long, offset long, entry boolean"
#: Parts into which the visitors of a time bucket (T4) or day (T2) are dealt, and all visitors (T1).  A key costs far
#: more than a row; a slot's state is read whole when the slot gets rows.
SLOTS = 32
VISITOR_SLOTS = 512


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("mid"), F.lit(slots)).cast("int").alias("slot")


def _firsts(rows: pd.DataFrame) -> pd.DataFrame:
    """Every visitor's first row by (ts, offset).  No visitor id is an id of its own."""
    ordered = rows.sort_values(["ts", "offset"], kind="stable", na_position="first")
    return ordered[~ordered["mid"].duplicated().to_numpy(bool)]


def _texts(ids: pd.Series) -> list[str | None]:
    return [m if isinstance(m, str) else None for m in ids.tolist()]


def new_visitor_flag(columns: list[str]):
    """Per visitor, the first ``is_new='1'`` record keeps '1'; later ones become '0'.

    Key: a slot of visitors.  State: the visitors seen, never expired (as in the original).  Rows of one
    micro-batch count in (ts, offset) order; only the visitors' candidates for the first one are held, every
    other row passes frame by frame.
    """
    def flagged(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = list(state.get[0]) if state.exists else []
        known = pd.Index(seen, dtype=object)
        held = None
        for pdf in rows:
            out = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            out = out.reset_index(drop=True)
            held = _firsts(out[(out["is_new"] == "1") & ~out["mid"].isin(known)])
            out = out.drop(held.index)
            if len(out):
                yield out.assign(is_new=out["is_new"].where(out["is_new"] != "1", "0"))[columns]
        if held is not None and len(held):
            state.update((seen + _texts(held["mid"]),))
            yield held[columns]
    return flagged


def first_visit(columns: list[str], ttl_ms: int):
    """The first entry of a visitor and day, emitted with the micro-batch that brings it.

    Key: a day and a slot of visitors.  State: each visitor seen on the day and the processing time at which that
    expires, ``ttl_ms`` after it was written.  There is no watermark, so a late entry of a day not seen yet is
    emitted too.  Of several entries in one micro-batch the first by (ts, offset) counts; frames are not gathered.
    """
    def first(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        seen = [(m, until) for m, until in zip(*state.get) if until > now] if state.exists else []
        held = None
        if not state.hasTimedOut:
            known = pd.Index([m for m, _ in seen], dtype=object)
            for pdf in rows:
                pdf = pdf[~pdf["mid"].isin(known)]
                held = _firsts(pdf if held is None else pd.concat([held, pdf], ignore_index=True))
            seen += [(m, now + ttl_ms) for m in _texts(held["mid"])] if held is not None else []
        if seen:
            state.update(([m for m, _ in seen], [until for _, until in seen]))
            state.setTimeoutDuration(min(until for _, until in seen) - now)
        elif state.exists:
            state.remove()
        if held is not None and len(held):
            yield held[columns]
    return first


class BounceDetector(StatefulProcessor):
    """T4: emit an entry page when the visitor's next event is absent for ``within``, is at
    least ``within`` later, or is itself an entry page.

    The key is (slot of visitors, time bucket), a bucket being ``within`` long: what follows an entry within ``within``
    lies in its own bucket or in the next one, so a bucket needs its own events and every visitor's first one of the
    next (``bounce_stream`` sends every event to both).  A busy visitor is spread over its buckets, and the visitors
    of a bucket over its slots: state and timers cost calls for each key, not for each visitor.

    State: in order of visitor and time, the bucket's entries that are not decided yet and, of every run of other pages
    of the visitor between them, the first and the last (an entry that arrives late inside a run is followed by a page
    of the run within ``within``, whichever it is); each visitor's first event of the next bucket; the time of the
    one timer.  The timer stands at the end of the first undecided entry's window and decides all
    entries whose window has ended; every earlier event has arrived then (later ones would be late).  With
    no entry left it stands where the bucket can get none any more, and clears it.
    """

    def __init__(self, within_ms: int):
        self.within = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", EVENT_SCHEMA)
        self.after = handle.getListState("after", EVENT_SCHEMA)
        self.timer = handle.getValueState("timer", "at long")

    @staticmethod
    def _load(state) -> pd.DataFrame:
        return pd.DataFrame([tuple(r) for r in state.get()], columns=EVENT)

    @staticmethod
    def _save(state, events: pd.DataFrame) -> None:
        if len(events):
            state.put([(m if isinstance(m, str) else None, int(t), int(o), bool(e)) for m, t, o, e in events.itertuples(index=False)])
        else:
            state.clear()

    @staticmethod
    def _sorted(events: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        """In order of visitor and time, and whether each row is its visitor's last.  No visitor id is an id of its own."""
        visitor = pd.factorize(events["mid"])[0]
        order = np.lexsort((events["offset"].to_numpy("int64"), events["ts"].to_numpy("int64"), visitor))
        visitor = visitor[order]
        return events.iloc[order].reset_index(drop=True), np.append(visitor[1:] != visitor[:-1], True)[:len(visitor)]

    @classmethod
    def _thinned(cls, events: pd.DataFrame) -> pd.DataFrame:
        """In order, without the pages that are neither an entry nor beside one, at the visitor's front or end."""
        events, last = cls._sorted(events)
        if not len(events):
            return events
        entry = events["entry"].to_numpy(bool)
        keep = entry | last
        keep[1:] |= (entry | last)[:-1]             # behind an entry, or the next visitor's first
        keep[:-1] |= entry[1:]
        keep[0] = True
        return events[keep].reset_index(drop=True)

    @classmethod
    def _firsts(cls, events: pd.DataFrame) -> pd.DataFrame:
        """Every visitor's first event."""
        events, last = cls._sorted(events)
        return events[np.append(True, last[:-1])[:len(last)]].reset_index(drop=True)

    def _set_timer(self, key, events: pd.DataFrame, before: int | None) -> None:
        entries = events["ts"].to_numpy("int64")[events["entry"].to_numpy(bool)]
        at = int(entries.min()) + self.within if len(entries) else (int(key[1]) + 2) * self.within
        if at != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events, after, new_after = self._load(self.held), None, False
        for pdf in rows:                        # frame by frame: what is held stays small
            own = pdf["own"].to_numpy(bool)
            new, following = pdf.loc[own, EVENT], pdf.loc[~own, EVENT]
            if len(following):
                after = self._load(self.after) if after is None else after
                after = self._firsts(following if not len(after) else pd.concat([after, following], ignore_index=True))
                new_after = True
            if len(new):
                events = self._thinned(new if not len(events) else pd.concat([events, new], ignore_index=True))
        if new_after:
            self._save(self.after, after)
        self._set_timer(key, events, self.timer.get()[0] if self.timer.exists() else None)
        self._save(self.held, events)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        before = self.timer.get()[0] if self.timer.exists() else None
        if before == fired:
            self.timer.clear()
            before = None
        end = (int(key[1]) + 2) * self.within
        now = min(max(fired, timerValues.getCurrentWatermarkInMs()), end)      # at the end the whole bucket is over
        events, last = self._sorted(self._load(self.held))
        after = self._load(self.after)
        ts, entry = events["ts"].to_numpy("int64"), events["entry"].to_numpy(bool)
        next_ts, next_entry = np.append(ts[1:], 0)[:len(ts)], np.append(entry[1:], False)[:len(ts)]
        alone = np.zeros(len(ts), bool)
        if last.any():
            at = pd.Index(after["mid"]).get_indexer(pd.Index(events["mid"][last]))
            alone[last] = at < 0
            next_ts[last] = np.append(after["ts"].to_numpy("int64"), 0)[at]
            next_entry[last] = np.append(after["entry"].to_numpy(bool), False)[at]
        due = entry & (ts + self.within <= now)
        bounced = events[due & (alone | (next_ts - ts >= self.within) | next_entry)]
        if now >= end:
            self.held.clear()
            self.after.clear()
        else:
            # an entry that is still to come lies behind the watermark, and so does what it needs
            waits = pd.Series(entry & ~due).groupby(np.cumsum(np.append(True, last[:-1])[:len(last)])).cummax().to_numpy(bool)
            events = events[waits | (ts >= now)].reset_index(drop=True)
            self._set_timer(key, events, before)
            self._save(self.held, events)
        if len(bounced):
            yield bounced[["offset", "mid", "ts"]].astype({"offset": "int64", "ts": "int64"})

    def close(self) -> None:
        pass


def new_flag_stream(logs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """T1 on a stream of valid log records (``common``, ``ts``, ``offset``); ``carry`` names text
    columns of ``logs`` that pass through."""
    flat = logs.select("offset", F.col("common.mid").alias("mid"),
                       F.col("common.is_new").alias("is_new"), "ts", *carry)
    schema = ", ".join([NEW_FLAG_OUTPUT, *[f"{c} string" for c in carry]])
    return flat.select("*", _slot(VISITOR_SLOTS)).groupBy("slot").applyInPandasWithState(
        new_visitor_flag(["offset", "mid", "is_new", *carry]), schema, "seen array<string>", "append", GroupStateTimeout.NoTimeout)


def unique_visit_stream(pages: DataFrame, ttl: str = VISIT_STATE_TTL) -> DataFrame:
    """T2/T3 on a stream of page records: the page record plus ``visit_day``, emitted at once.

    Keyed by (day, slot of visitors), so a busy visitor is spread over its days.  The processing-time
    expiry asks for a micro-batch after every one, also without new data; run finite inputs with
    ``spark.sql.streaming.noDataMicroBatches.enabled=false``.
    """
    entries = pages.filter(is_entry_page()).select(
        F.col("common.mid").alias("mid"), day_text(event_time("ts")).alias("visit_day"), "ts", "offset",
        F.to_json(F.struct(*pages.columns)).alias("record"))
    first = entries.select("*", _slot(SLOTS)).groupBy("visit_day", "slot").applyInPandasWithState(
        first_visit(["visit_day", "record"], duration_ms(ttl)), "visit_day string, record string", "mid array<string>, until array<long>",
        "append", GroupStateTimeout.ProcessingTimeTimeout)
    return first.select(F.from_json("record", pages.schema).alias("r"), "visit_day").select("r.*", "visit_day")


def bounce_stream(pages: DataFrame, within: str = BOUNCE_WITHIN,
                  delay: str = WATERMARK_DELAY["bounce"]) -> DataFrame:
    """T4 on a stream of page records, watermark ``delay`` on the event time.  Records without a time take no
    part (``visits.untimed`` is their side output).  The visitor's records are only compared with one another, so
    a missing visitor id is an id of its own."""
    ms = duration_ms(within)
    ev = (pages.filter(F.col("ts").isNotNull())
               .select(F.coalesce("offset", F.lit(0)).alias("offset"), F.col("common.mid").alias("mid"), "ts",
                       is_entry_page().alias("entry"), event_time("ts").alias("__et"))
               .withWatermark("__et", delay))
    bucket = F.floor(F.col("ts") / ms).cast("bigint")
    places = F.explode(F.array(F.struct(bucket.alias("bucket"), F.lit(True).alias("own")),
                               F.struct((bucket - 1).alias("bucket"), F.lit(False).alias("own"))))
    ev = ev.select("*", places.alias("__p")).select("offset", "mid", "ts", "entry", "__et", _slot(SLOTS), "__p.bucket", "__p.own")
    return ev.groupBy("slot", "bucket").transformWithStateInPandas(
        BounceDetector(ms), BOUNCE_OUTPUT, "Append", "EventTime")
