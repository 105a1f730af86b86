"""Sessions with status rows, kept in custom state."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = (
    "customer_id string, session_start timestamp, last_event_time timestamp, "
    "event_count bigint, total_amount double, session_status string"
)
STATE = "sessions string"


def join_pieces(pieces: list[list], gap: int) -> list[list]:
    """Unite ``[start, last, count, total]`` pieces that are less than ``gap`` apart."""
    merged: list[list] = []
    for start, last, count, total in sorted(pieces):
        if merged and start - merged[-1][1] < gap:
            top = merged[-1]
            merged[-1] = [top[0], max(top[1], last), top[2] + count, top[3] + total]
        else:
            merged.append([start, last, count, total])
    return merged


FRAGMENT = (
    "customer_id string, start_us bigint, last_us bigint, events bigint, amount double, "
    "last_at timestamp"
)
PIECE = ("customer_id", "start_us", "last_us", "events", "amount")


def fragments(batches: Iterator[pd.DataFrame], gap: int) -> Iterator[pd.DataFrame]:
    """Shrink each Arrow batch to pieces of sessions, before anything is shuffled.

    A pause of ``gap`` or more ends a session, as in Spark's own session windows. All
    customers of a batch are cut in one go, since most have few events in it.
    """
    for pdf in batches:
        at = pdf["event_timestamp"].astype("datetime64[us]").astype("int64").to_numpy()
        customer, names = pd.factorize(pdf["customer_id"])
        order = np.lexsort((at, customer))
        at, customer = at[order], customer[order]
        begins = np.ones(len(at), dtype=bool)
        begins[1:] = (np.diff(customer) != 0) | (np.diff(at) >= gap)
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(at))[: len(first)] - 1
        out = pd.DataFrame(
            {
                "customer_id": names.take(customer[first]),
                "start_us": at[first],
                "last_us": at[last],
                "events": last - first + 1,
                "amount": np.add.reduceat(pdf["amount"].fillna(0.0).to_numpy()[order], first),
            }
        )
        out["last_at"] = pd.to_datetime(out["last_us"], unit="us")
        yield out


def by_customer(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, list[list]]]:
    """The pieces of each customer, handed on when there are more than ever before, so that
    sessions of a busy customer are not joined anew for every Arrow batch."""
    found: dict[str, list[list]] = {}
    held, most = 0, 10_000
    for pdf in batches:
        for customer, *piece in zip(*(pdf[c].tolist() for c in PIECE), strict=True):
            found.setdefault(customer, []).append(piece)
        held += len(pdf)
        if held > most:
            yield found
            found, held, most = {}, 0, 2 * most
    if found:
        yield found


def track_sessions(stream: DataFrame, delay: str, gap_minutes: int = 30, slots: int = 4096) -> DataFrame:
    """ACTIVE rows for open sessions that changed and a TIMED_OUT row when one ends.

    ``stream`` has ``customer_id string, event_timestamp timestamp, amount double``. A
    session ends when the watermark, ``delay`` behind the newest event, passes its last
    event by the gap. Every task first folds its events into pieces of sessions, so a very
    busy customer sends a few rows through the shuffle. A piece is late when its last event is.

    Python is called, and keeps one state record, for each of ``slots`` hashed groups of
    customers: a call for each customer would cost more than its events. A record holds the
    open sessions of some customers, so take more slots for very many of them; a checkpoint
    keeps the number it began with.
    """
    gap = gap_minutes * 60_000_000
    pieces = (
        stream.where("customer_id IS NOT NULL AND event_timestamp IS NOT NULL")
        .select("customer_id", "event_timestamp", "amount")
        .mapInPandas(lambda batches: fragments(batches, gap), FRAGMENT)
        .withWatermark("last_at", delay)
        .withColumn("slot", F.pmod(F.xxhash64("customer_id"), F.lit(slots)))
    )

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sessions = json.loads(state.get[0]) if state.exists else {}
        changed = set()
        if not state.hasTimedOut:
            for found in by_customer(batches):
                for customer, own in found.items():
                    sessions[customer] = join_pieces([*sessions.get(customer, []), *own], gap)
                changed.update(found)
        now = state.getCurrentWatermarkMs() * 1000
        ended, active, still_open = [], [], {}
        for customer, own in sessions.items():
            ended += [(customer, *s) for s in own if s[1] + gap <= now]
            if left := [s for s in own if s[1] + gap > now]:
                still_open[customer] = left
                active += [(customer, *s) for s in left] if customer in changed else []
        if still_open:
            state.update((json.dumps(still_open),))
            # sessions of a customer lie in order, so the first one ends first
            state.setTimeoutTimestamp((min(own[0][1] for own in still_open.values()) + gap) // 1000 + 1)
        elif state.exists:
            state.remove()
        if ended or active:
            customer, start, last, count, total = zip(*ended, *active, strict=True)
            yield pd.DataFrame(
                {
                    "customer_id": customer,
                    "session_start": np.array(start, dtype="datetime64[us]"),
                    "last_event_time": np.array(last, dtype="datetime64[us]"),
                    "event_count": count,
                    "total_amount": total,
                    "session_status": ["TIMED_OUT"] * len(ended) + ["ACTIVE"] * len(active),
                }
            )

    return pieces.groupBy("slot").applyInPandasWithState(
        update, OUTPUT, STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
