"""Session features while the session is open, keyed by profile.

Every event updates its session and emits the session's features; a session ends
after 30 minutes of silence in event time.  The arithmetic is the batch one
(heartbeats of 10 seconds, clamped rebuffering, completion against the runtime).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from kinolytics import schemas as S

c = F.col
GAP_MS = 30 * 60 * 1000
DAY_MS = 86_400_000
OUTPUT = (
    "profile_id bigint, session_id string, session_start timestamp, title_id bigint, region_code string, device_type string, seconds_watched bigint, completion_ratio double, seek_count bigint,"
    " pause_count bigint, rebuffer_count bigint, rebuffer_seconds double, startup_ms int, avg_bitrate_kbps double, had_error boolean, event_count bigint,"
    " sessions_last_7d bigint, distinct_titles_last_7d bigint, genre_affinity string, updated_ts timestamp, final boolean"
)
NAMES = [x.strip().split(" ")[0] for x in OUTPUT.split(",")]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def begin(ts: int, title: int, region: str, device: str, runtime: Any) -> dict:
    return {"start": ts, "last": ts, "title": title, "region": region, "device": device, "beats": 0, "seeks": 0, "pauses": 0, "stalls": 0, "stall_ms": 0, "startup": None, "bits": 0, "bit_n": 0, "error": False, "n": 0, "runtime": number(runtime)}


def apply(s: dict, ts: int, kind: str, ms: Any, startup: Any, bits: Any, runtime: Any) -> None:
    """One event on a session's state; the same sums as the batch aggregate."""
    if ts > s["last"]:
        s["last"] = ts
    s["n"] += 1
    if kind == "HEARTBEAT":
        s["beats"] += 1
    elif kind == "SEEK":
        s["seeks"] += 1
    elif kind == "PAUSE":
        s["pauses"] += 1
    elif kind == "REBUFFER":
        s["stalls"] += 1
    elif kind == "ERROR":
        s["error"] = True
    ms, bits = number(ms), number(bits)
    if ms is not None and 0 <= ms <= S.REBUFFER_CAP_MS:
        s["stall_ms"] += ms
    if kind == "START" and (startup := number(startup)) is not None:
        s["startup"] = startup if s["startup"] is None else max(s["startup"], startup)
    if bits is not None:
        s["bits"], s["bit_n"] = s["bits"] + bits, s["bit_n"] + 1
    if s["runtime"] is None:
        s["runtime"] = number(runtime)


def number(x: Any) -> int | None:
    return None if x is None or x != x else int(x)


class Rollup:
    """Sessions, titles and seconds by genre over the seven days up to a session's last event; kept up to date while its day lasts."""

    def __init__(self, days: dict[int, dict]):
        self.days, self.day = days, None

    def at(self, day: int) -> None:
        if day == self.day:
            return
        near = [v for d, v in self.days.items() if d > day - 7]
        self.day, self.sessions, self.titles, self.genres = day, sum(len(v["s"]) for v in near), {t for v in near for t in v["t"]}, {}
        for v in near:
            for g, n in v["g"].items():
                self.genres[g] = self.genres.get(g, 0) + n
        self.shares = None

    def add(self, day: int, session: str, known: set[str], title: int, genre: Any, seconds: int) -> None:
        bucket = self.days.setdefault(day, {"s": [], "t": [], "g": {}})
        near = self.day is not None and day > self.day - 7
        if session not in known:
            known.add(session)
            bucket["s"].append(session)
            if near:
                self.sessions += 1
        if title not in bucket["t"]:
            bucket["t"].append(title)
            if near:
                self.titles.add(title)
        if seconds and isinstance(genre, str):
            bucket["g"][genre] = bucket["g"].get(genre, 0) + seconds
            if near:
                self.genres[genre] = self.genres.get(genre, 0) + seconds
                self.shares = None

    def affinity(self) -> str:
        if self.shares is None:
            total = sum(self.genres.values())
            self.shares = json.dumps({g: round(n / total, 4) for g, n in sorted(self.genres.items())} if total else {})
        return self.shares


def emitted(profile: int, session: str, s: dict, rollup: Rollup, final: bool) -> tuple:
    watched, runtime = s["beats"] * S.HEARTBEAT_SECONDS, s["runtime"]
    rollup.at(s["last"] // DAY_MS)
    return (profile, session, s["start"], s["title"], s["region"], s["device"], watched, min(1.0, watched / runtime) if runtime else None, s["seeks"], s["pauses"], s["stalls"], s["stall_ms"] / 1000.0, s["startup"],
            s["bits"] / s["bit_n"] if s["bit_n"] else None, s["error"], s["n"], rollup.sessions, len(rollup.titles), rollup.affinity(), s["last"], final)


def frame(out: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(out, columns=NAMES)
    for name in ("session_start", "updated_ts"):
        df[name] = pd.to_datetime(df[name], unit="ms")
    return df


class Sessions(StatefulProcessor):
    """State by profile, one value: its open sessions, a bucket for each of the last 7 days (sessions, titles, seconds by genre), and the time of its timer.

    There is one timer for each profile.  It is not moved with every event: when it rings, what is over is closed and it is set
    again for what is not.  With no session open it waits for the day on which the last bucket leaves the seven days; then nothing is kept.
    """

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.state = handle.getValueState("profile_v2", "state string")

    def load(self) -> tuple[dict[str, dict], dict[int, dict], int | None]:
        held = json.loads(self.state.get()[0]) if self.state.exists() else {"open": {}, "days": {}, "timer": None}
        return held["open"], {int(d): v for d, v in held["days"].items()}, held["timer"]

    def save(self, open_: dict[str, dict], days: dict[int, dict], timer: int | None) -> None:
        """Set the timer if there is none or it would be late, and keep the state, or nothing if it is empty."""
        if days:
            newest = max(days)
            for d in [d for d in days if d <= newest - 7]:
                days.pop(d)
        due = min((s["last"] + GAP_MS for s in open_.values()), default=(max(days) + 7) * DAY_MS if days else None)
        if due is None:
            self.state.clear()
            return
        if timer is None or due < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
            timer = due
        self.state.update((json.dumps({"open": open_, "days": days, "timer": timer}),))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        profile = int(key[0])
        parts = list(rows)
        events = (pd.concat(parts) if len(parts) > 1 else parts[0]).sort_values(["ts", "event_id"])
        open_, days, timer = self.load()
        rollup, known = Rollup(days), {x for v in days.values() for x in v["s"]}
        out = []
        columns = (events[n].tolist() for n in ("ts", "session_id", "title_id", "region_code", "device_type", "event_type", "rebuffer_ms", "startup_ms", "bitrate_kbps", "runtime_seconds", "primary_genre"))
        for ts, session, title, region, device, kind, ms, startup, bits, runtime, genre in zip(*columns, strict=True):
            s = open_.get(session)
            if s is not None and ts > s["last"] + GAP_MS:  # rows come before timers: the silence was long enough
                out.append(emitted(profile, session, s, rollup, True))
                s = None
            if s is None:
                s = open_[session] = begin(ts, title, region, device, runtime)
            apply(s, ts, kind, ms, startup, bits, runtime)
            rollup.at(s["last"] // DAY_MS)
            rollup.add(ts // DAY_MS, session, known, title, genre, S.HEARTBEAT_SECONDS if kind == "HEARTBEAT" else 0)
            out.append(emitted(profile, session, s, rollup, False))
        self.save(open_, days, timer)
        yield frame(out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = expiredTimerInfo.getExpiryTimeInMs()
        open_, days, _ = self.load()
        rollup, out = Rollup(days), []
        for session in [k for k, s in open_.items() if s["last"] + GAP_MS <= now]:
            out.append(emitted(int(key[0]), session, open_.pop(session), rollup, True))
        if not open_:
            for d in [d for d in days if (d + 7) * DAY_MS <= now]:
                days.pop(d)
        self.save(open_, days, None)
        if out:
            yield frame(out)

    def close(self) -> None:
        pass


def session_features(events: DataFrame, titles: DataFrame, lateness: str = "5 minutes", output_mode: str = "update") -> DataFrame:
    """Features of each session after each of its events.  ``titles``: static (title_id, runtime_seconds, primary_genre).

    Repeated events within the watermark are dropped.  Emission does not wait for the watermark in update mode, so a
    generous lateness costs no freshness; it only puts off the final record.  Later rows are dropped and counted by Spark.
    """
    e = events.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(["event_id"])
    e = e.join(titles.select("title_id", "runtime_seconds", "primary_genre"), "title_id", "left")
    e = e.select("profile_id", "session_id", "event_id", "title_id", "region_code", "device_type", "event_type", F.unix_millis("event_ts").alias("ts"), "rebuffer_ms", "startup_ms", "bitrate_kbps", "runtime_seconds", "primary_genre", "event_ts")
    return e.groupBy("profile_id").transformWithStateInPandas(Sessions(), OUTPUT, output_mode, "eventTime")  # type: ignore[arg-type]


def with_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def batch_sessions(events: DataFrame) -> DataFrame:
    """The closed-session twin: the same sums by gap, from a table."""
    w = F.session_window("event_ts", S.SESSION_GAP)
    kind = lambda n: F.count_if(c("event_type") == n)
    return events.dropDuplicates(["event_id"]).groupBy("profile_id", "session_id", w.alias("w")).agg(
        (kind("HEARTBEAT") * S.HEARTBEAT_SECONDS).alias("seconds_watched"), kind("SEEK").alias("seek_count"), kind("PAUSE").alias("pause_count"), kind("REBUFFER").alias("rebuffer_count"),
        (F.coalesce(F.sum(F.when(c("rebuffer_ms").between(0, S.REBUFFER_CAP_MS), c("rebuffer_ms"))), F.lit(0)) / 1000.0).alias("rebuffer_seconds"), (kind("ERROR") > 0).alias("had_error"), F.count("*").alias("event_count"),
    ).select("profile_id", "session_id", c("w.start").alias("session_start"), "seconds_watched", "seek_count", "pause_count", "rebuffer_count", "rebuffer_seconds", "had_error", "event_count")
