"""Packet streams: validation, rates, presence, rosters, deduplication, batching, lateness, level of detail.

Everything built from windows and watermarks runs unchanged on a batch or a stream. What needs memory per key (lateness
over the last 40 packets, hysteresis, stalls) is a stateful processor, and its batch twin replays the same rule in order."""
from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField, StructType)

from placeloom.functions.catalogs import PACKET_TYPES
from placeloom.functions.shapes import clamp
from placeloom.operators.scale import _with_offsets, spread_row_number, top_k, with_next

POSE = StructType([StructField(n, DoubleType()) for n in ("x", "z", "heading", "speed")])
DATA = StructType([StructField("t", DoubleType()), StructField("vehicle", StringType()), StructField("pose", POSE), StructField("health", DoubleType()), StructField("life", DoubleType())])
PACKET = StructType([StructField("type", StringType()), StructField("from", StringType()), StructField("target", StringType()), StructField("data", DATA)])
# Health of each vehicle.
HEALTH = {"interceptor": 130.0, "raider": 100.0, "wartruck": 200.0}


def parse_packets(raw: DataFrame, column: str = "value") -> DataFrame:
    rest = [c for c in raw.columns if c != column]
    return raw.select(*rest, F.from_json(column, PACKET).alias("p")).select(*rest, "p.*")


def valid_packets(packets: DataFrame) -> DataFrame:
    """Known types only; a state needs a known vehicle and a finite pose, which is clamped to the world; health is clamped
    to the vehicle's."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    most = F.try_element_at(F.create_map(*[F.lit(v) for p in HEALTH.items() for v in p]), F.col("data.vehicle"))
    state_ok = most.isNotNull() & finite("data.pose.x") & finite("data.pose.z") & finite("data.pose.heading")
    kept = packets.filter(F.col("type").isin(PACKET_TYPES) & ((F.col("type") != "state") | state_ok))
    bound = lambda c: clamp(F.col(c), -5000.0, 5000.0)
    return kept.withColumns({"x": bound("data.pose.x"), "z": bound("data.pose.z"), "heading": bound("data.pose.heading"), "health": F.when(most.isNotNull(), clamp(F.coalesce("data.health", F.lit(0.0)), F.lit(0.0), most))})


# ---------------------------------------------------------------- windows and watermarks: batch and stream
def rate_breaches(packets: DataFrame, window: str, limit: int, time: str = "ts") -> DataFrame:
    """Senders with more than `limit` messages in an aligned window."""
    return packets.groupBy("sender", F.window(time, window).alias("w")).agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("sender", F.col("w.start").alias("start"), "n")


def on_time(packets: DataFrame, delay: str, time: str = "ts", key: str = "event_id") -> DataFrame:
    """Packets, each once, that come no more than `delay` behind the latest one of the batches before; a stream counts the others as dropped
    by its watermark. On a batch nothing is late."""
    return packets.withWatermark(time, delay).dropDuplicates([key, time])


def presence_sessions(packets: DataFrame, gap: str, time: str = "ts") -> DataFrame:
    """Stretches of a sender without a silence longer than `gap`."""
    return packets.groupBy("sender", F.session_window(time, gap).alias("s")).agg(F.count("*").alias("n")).select("sender", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def dedupe_deaths(packets: DataFrame, time: str = "ts") -> DataFrame:
    """The first death per sender and life. On a stream (with a watermark) duplicates are forgotten once they are too late to
    come; a batch keeps the earliest."""
    deaths = packets.filter("type = 'death'")
    if packets.isStreaming:
        return deaths.dropDuplicatesWithinWatermark(["sender", "life"])
    first = deaths.groupBy("sender", "life").agg(F.min_by(F.struct(*[c for c in deaths.columns if c not in ("sender", "life")]), F.struct(time, "event_id")).alias("f"))
    return first.select("sender", "life", "f.*")


def batch_hits(packets: DataFrame, flush: str, cap: float, time: str = "ts") -> DataFrame:
    """Damage per target and weapon per flush window, capped; non-positive amounts are dropped."""
    hits = packets.filter("type = 'hit' AND amount > 0")
    sums = hits.groupBy("target", "weapon", F.window(time, flush).alias("w")).agg(F.sum("amount").alias("amount"), F.count("*").alias("hits"))
    return sums.select("target", "weapon", F.col("w.start").alias("start"), F.least("amount", F.lit(cap)).alias("amount"), "hits")


def sliding_activity(packets: DataFrame, window: str, slide: str, time: str = "ts") -> DataFrame:
    return packets.groupBy("sender", F.window(time, window, slide).alias("w")).agg(F.count("*").alias("n")).select("sender", F.col("w.start").alias("start"), "n")


# ---------------------------------------------------------------- rosters and interpolation (batch)
def room_roster(packets: DataFrame, cap: int = 8) -> DataFrame:
    """Members of each room in joining order (at most `cap`, the first is host) with their last state."""
    members = packets.groupBy("room", "sender").agg(F.min(F.struct("ts", "event_id")).alias("joined"), F.max_by(F.struct("event_id", "amount"), F.when(F.col("type") == "state", F.struct("ts", "event_id"))).alias("last"))
    ranked = top_k(members.select("room", "sender", F.col("joined.ts").alias("joined_at"), F.col("joined.event_id").alias("joined_id"), F.col("last.event_id").alias("last_state")), ["room"], [F.col("joined_at"), F.col("joined_id")], cap, "seat", salts=1)
    return ranked.withColumn("host", F.col("seat") == 1)


def room_stays(packets: DataFrame, gap: str, time: str = "ts") -> DataFrame:
    """Stays (room, sender, joined, left, n, last_state) of senders in rooms: a sender joins with a packet and leaves when `gap` has passed without another.

    The same on a batch and on a stream. A stream needs a watermark: it writes a stay when the mark passes its end and forgets it then, so its
    state holds those who are present and no others. Packets without a time are left out; a NULL room is a room."""
    newest = F.max_by("event_id", F.when(F.col("type") == "state", F.struct(time, "event_id")))
    stays = packets.groupBy("room", "sender", F.session_window(time, gap).alias("s")).agg(F.count("*").alias("n"), newest.alias("last_state"))
    return stays.select("room", "sender", F.col("s.start").alias("joined"), F.col("s.end").alias("left"), "n", "last_state")


def room_hosts(stays: DataFrame) -> DataFrame:
    """Terms (room, sender, since_us, until_us) of the hosts of each room: of those present the one who joined first, of equal times the lowest sender.

    Whoever comes after others is host from the last leaving of all of them to the own leaving; that is a running maximum over the order of joining."""
    from placeloom.operators.scale import running_min
    times = stays.select("room", "sender", F.unix_micros("joined").alias("joined"), F.unix_micros("left").alias("left"))
    order = spread_row_number(times, ["room"], ["joined", "sender"], "k")
    ends = running_min(order, ["room"], "k", -F.col("left"), "_low")
    later = with_next(ends, ["room"], "k", ["_low", "sender", "joined", "left"])
    later = later.select("room", F.col("next_sender").alias("sender"), F.greatest("next_joined", -F.col("_low")).alias("since_us"), F.col("next_left").alias("until_us"))
    first = ends.filter("k = 1").select("room", "sender", F.col("joined").alias("since_us"), F.col("left").alias("until_us"))
    return first.unionByName(later.filter("since_us < until_us"))


def interpolate_states(states: DataFrame, probes: DataFrame, stale_ms: float) -> DataFrame:
    """Pose of each probe (sender, probe_id, at_ms): between the two samples (event_id, t_ms, x, heading) round it, heading the
    short way; `stale` when the newest sample before it is older than `stale_ms`.

    As-of join without a cross join: samples and probes are numbered together in time order per sender, and the last
    sample before a probe is a running maximum over that order, split into buckets."""
    from placeloom.operators.scale import running_sum
    rows = states.select("sender", "t_ms", F.lit(0).alias("kind"), F.col("event_id").alias("id"), "x", "heading").unionByName(
        probes.select("sender", F.col("at_ms").alias("t_ms"), F.lit(1).alias("kind"), F.col("probe_id").alias("id"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("heading")))
    ordered = spread_row_number(rows, ["sender"], ["t_ms", "kind", "id"], "n")
    counted = running_sum(ordered, ["sender"], "n", F.when(F.col("kind") == 0, 1).otherwise(0), "sample_no")
    samples = counted.filter("kind = 0").select("sender", F.col("sample_no").alias("no"), "t_ms", "x", "heading")
    asked = counted.filter("kind = 1").select("sender", F.col("id").alias("probe_id"), F.col("t_ms").alias("at_ms"), "sample_no")
    spans = with_next(samples, ["sender"], "no", ["t_ms", "x", "heading"]).select("sender", "no", "next_t_ms", "next_x", "next_heading")
    near = asked.join(samples.withColumnRenamed("no", "sample_no"), ["sender", "sample_no"]).join(spans.withColumnRenamed("no", "sample_no"), ["sender", "sample_no"], "left")
    t = F.when(F.col("next_t_ms").isNull(), 0.0).otherwise(clamp((F.col("at_ms") - F.col("t_ms")) / F.greatest(F.lit(1.0), F.col("next_t_ms") - F.col("t_ms")), 0.0, 1.0))
    turn = F.coalesce(F.atan2(F.sin(F.col("next_heading") - F.col("heading")), F.cos(F.col("next_heading") - F.col("heading"))), F.lit(0.0))
    return near.select("sender", "probe_id", (F.col("x") + (F.coalesce("next_x", "x") - F.col("x")) * t).alias("x"), (F.col("heading") + turn * t).alias("heading"), (F.col("at_ms") - F.col("t_ms") > stale_ms).alias("stale"))


# ---------------------------------------------------------------- state per key (stream)
LATENESS_OUT = StructType([StructField("sender", LongType()), StructField("event_id", LongType()), StructField("offset_ms", DoubleType()), StructField("worst_ms", DoubleType()), StructField("delay_ms", DoubleType())])


class Lateness(StatefulProcessor):
    """Smallest travel time so far and the last 40 latenesses of a sender."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.offset = handle.getValueState("offset", StructType([StructField("v", DoubleType())]))
        self.ring = handle.getValueState("ring", StructType([StructField("v", ArrayType(DoubleType()))]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        offset = self.offset.get()[0] if self.offset.exists() else math.inf
        ring = list(self.ring.get()[0]) if self.ring.exists() else []
        batch = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        out = []
        for event, travel in zip(batch["event_id"], batch["travel_ms"]):
            offset = min(offset, float(travel))
            ring = (ring + [float(travel) - offset])[-40:]
            out.append((key[0], event, offset, max(ring), min(max(60 + max(ring), 80.0), 250.0)))
        self.offset.update((offset,))
        self.ring.update((ring,))
        yield pd.DataFrame(out, columns=[f.name for f in LATENESS_OUT.fields])

    def close(self) -> None:
        pass


def delivery_lateness_stream(packets: DataFrame) -> DataFrame:
    return packets.select("sender", "event_id", "ts", "travel_ms").groupBy("sender").transformWithStateInPandas(Lateness(), LATENESS_OUT, "Append", "None")


ROSTER_OUT = StructType([StructField("room", LongType()), StructField("sender", LongType()), StructField("seat", LongType()), StructField("last_state", LongType())])


class Roster(StatefulProcessor):
    """Joining order and last state of a room's members; the roster is emitted after every batch."""

    def __init__(self, cap: int = 8):
        self.cap = cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.joined = handle.getMapState("joined", StructType([StructField("sender", LongType())]), StructType([StructField("ts", LongType()), StructField("event_id", LongType()), StructField("last_ts", LongType()), StructField("last_id", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for sender, ts, event, kind in zip(batch["sender"], batch["ts_us"], batch["event_id"], batch["type"]):
                old = self.joined.getValue((sender,)) if self.joined.containsKey((sender,)) else None
                first, last = (ts, event), (-1, -1)
                if old is not None:
                    first, last = min(first, (old[0], old[1])), (old[2], old[3])
                if kind == "state":
                    last = max(last, (ts, event))
                self.joined.updateValue((sender,), (*first, *last))
        seats = sorted((v[0], v[1], k[0], v[3]) for k, v in self.joined.iterator())[:self.cap]
        yield pd.DataFrame([(key[0], s[2], n, s[3] if s[3] >= 0 else None) for n, s in enumerate(seats, 1)], columns=[f.name for f in ROSTER_OUT.fields]).astype({"last_state": "Int64"})

    def close(self) -> None:
        pass


def room_roster_stream(packets: DataFrame, cap: int = 8) -> DataFrame:
    rows = packets.select("room", "sender", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_id", "type")
    return rows.groupBy("room").transformWithStateInPandas(Roster(cap), ROSTER_OUT, "Update", "None")


# ---------------------------------------------------------------- hysteresis and stalls: ordered replay per key
LEVEL_OUT = StructType([StructField("viewer", LongType()), StructField("tile", LongType()), StructField("n", LongType()), StructField("level", LongType())])


def next_level(previous: int, distance: float, limits: tuple[float, ...] = (75.0, 125.0), slack: float = 6.0) -> int:
    """Level of detail: each limit moves away from the level the tile is at."""
    for k, limit in enumerate(limits):
        if distance < (limit - slack if previous > k else limit + slack):
            return k
    return len(limits)


def next_loaded(previous: bool, distance: float, load: float = 100.0, unload: float = 170.0) -> bool:
    return distance < load or (previous and distance <= unload)


STRETCH = 1024


def _starts(maps: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """State before each stretch, from the stretches' maps (keys, _b, after). Maps of 1024 stretches are composed into one
    map first, `depth` times, so the last chain per key is short: 10^9 samples leave a thousand maps."""
    group = [*keys, "_p"] if depth else keys
    spread = maps.withColumn("_p", F.floor(F.col("_b") / STRETCH)) if depth else maps
    lists = spread.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_b", "after"))).alias("_m"))
    zero = F.lit(0).cast("bigint")
    if depth:
        start = F.transform(F.get("_m", F.lit(0))["after"], lambda _, k: k.cast("bigint"))
        whole = F.aggregate("_m", start, lambda acc, m: F.transform(acc, lambda s: F.get(m["after"], s.cast("int"))))
        upper = _starts(lists.select(*keys, F.col("_p").alias("_b"), whole.alias("after")), keys, depth - 1).withColumnsRenamed({"_b": "_p", "start": "_s"})
        lists = _with_offsets(lists, upper, group)
    first = F.struct((F.col("_s") if depth else zero).alias("s"), F.slice(F.transform("_m", lambda m: zero), 1, 0).alias("out"))
    chain = F.aggregate("_m", first, lambda acc, m: F.struct(F.get(m["after"], acc["s"].cast("int")).alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out")), lambda acc: acc["out"])
    return lists.select(*keys, F.explode(F.arrays_zip(F.col("_m._b").alias("_b"), chain.alias("start"))).alias("_q")).select(*keys, "_q._b", "_q.start")


def hysteresis_runs(samples: DataFrame, keys: list[str], order: str, states: int, step) -> DataFrame:
    """Replay `state = step(state, value)` along dense `order` per key without gathering a key in one task.

    A step is a function on a few states, so a stretch of samples is the map {state before: state after}. Stretches of 1024
    samples are folded in parallel, the small maps are chained, then each stretch is replayed from its start. A stretch is a
    row with its samples as a list, so Python gets many of them in one batch.
    `samples(keys..., order, value)`; `step(state, value)` is plain Python used inside Arrow batches."""
    @F.pandas_udf("array<bigint>")
    def folded(values: pd.Series) -> pd.Series:
        def fold(run):
            after = []
            for state in range(states):
                for v in run:
                    state = int(step(state, v))
                after.append(state)
            return after
        return values.map(lambda run: fold(run.tolist()))

    @F.pandas_udf("array<bigint>")
    def replayed(values: pd.Series, start: pd.Series) -> pd.Series:
        def replay(run, state):
            out = []
            for v in run:
                state = int(step(state, v))
                out.append(state)
            return out
        return pd.Series([replay(run.tolist(), state) for run, state in zip(values, start)])

    block = samples.withColumn("_b", F.floor(F.col(order) / STRETCH))
    lists = block.groupBy(*keys, "_b").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("n"), F.col("value").alias("v")))).alias("_r"))
    starts = _starts(lists.select(*keys, "_b", folded(F.col("_r.v")).alias("after")), keys, 1)
    done = _with_offsets(lists, starts, [*keys, "_b"]).withColumn("_o", replayed(F.col("_r.v"), F.col("start")))
    return done.select(*keys, F.explode(F.arrays_zip(F.col("_r.n").alias("n"), F.col("_o").alias("state"))).alias("_q")).select(*keys, F.col("_q.n").alias(order), "_q.state")


def lod_levels(samples: DataFrame, keys: list[str], order: str) -> DataFrame:
    return hysteresis_runs(samples, keys, order, 3, next_level)


def interest_tiles(samples: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Whether a tile is loaded (1) after each sample of its distance to the viewer."""
    return hysteresis_runs(samples, keys, order, 2, next_loaded)


class Hysteresis(StatefulProcessor):
    """The same rules on a stream: the previous state of each (viewer, tile)."""

    def __init__(self, rule: str):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", StructType([StructField("v", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        step = next_level if self.rule == "lod" else next_loaded
        state, out = (self.state.get()[0] if self.state.exists() else 0), []
        batch = pd.concat(list(rows)).sort_values("n")
        for n, value in zip(batch["n"], batch["value"]):
            state = int(step(state, value))
            out.append((key[0], key[1], n, state))
        self.state.update((state,))
        yield pd.DataFrame(out, columns=[f.name for f in LEVEL_OUT.fields])

    def close(self) -> None:
        pass


def hysteresis_stream(samples: DataFrame, rule: str) -> DataFrame:
    return samples.select("viewer", "tile", "n", "value").groupBy("viewer", "tile").transformWithStateInPandas(Hysteresis(rule), LEVEL_OUT, "Append", "None")


def stall_detection(samples: DataFrame, window_s: float = 0.75, still: float = 0.7, slow: float = 2.0, advance: float = 6.0) -> DataFrame:
    """Stuck time per car and window: in each window of `window_s` a car that moved less than `still` while blocked or slow adds the
    window to its stuck time, any other window resets it. `samples(car, at_s, x, z, speed, blocked)`.

    Windows are aligned; stuck time is the length of the current run of stuck windows (gaps and islands by counting)."""
    w = F.floor(F.col("at_s") / window_s).cast("bigint")
    per = samples.groupBy("car", w.alias("w")).agg(F.min_by(F.struct("x", "z"), "at_s").alias("a"), F.max_by(F.struct("x", "z", "speed"), "at_s").alias("e"), F.bool_or("blocked").alias("blocked"))
    moved = F.sqrt((F.col("e.x") - F.col("a.x")) * (F.col("e.x") - F.col("a.x")) + (F.col("e.z") - F.col("a.z")) * (F.col("e.z") - F.col("a.z")))
    flagged = per.select("car", "w", moved.alias("moved"), ((moved < still) & (F.col("blocked") | (F.abs("e.speed") < slow))).alias("stuck"))
    dense = spread_row_number(flagged, ["car"], ["w"], "n")
    from placeloom.operators.scale import running_sum
    runs = running_sum(dense, ["car"], "n", F.when(F.col("stuck"), 0).otherwise(1), "run")
    length = running_sum(runs.withColumn("_one", F.when(F.col("stuck"), 1).otherwise(0)), ["car", "run"], "n", F.col("_one"), "stuck_windows")
    return length.select("car", "w", "moved", "stuck", (F.col("stuck_windows") * window_s).alias("stuck_s"), (F.col("moved") > advance).alias("advanced"))
