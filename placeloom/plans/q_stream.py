"""Packet queries over the events table; the last ones run as streams and must equal their batch twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions.scalars import half_up
from placeloom.plans.q_aggregate import TRAVEL
from placeloom.plans.q_sources import scratch
from placeloom.plans.registry import query
from placeloom.streaming import packets as pk, run

K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def with_fields(p):
    """Packets of the events table with the number in their properties."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return p.withColumns({"k": k, "life": k % 10, "weapon": F.when(F.col("event_id") % 2 == 0, "guns").otherwise("flame"), "travel_ms": k * 3, "ts": F.col("ts").cast("timestamp")})


def packets(t):
    return with_fields(t.f_packets)


@query("valid_packets", """SELECT event_id, CAST(least(greatest(event_id * 7919 % 12001 - 6000, -5000), 5000) AS BIGINT) AS x, CAST(floor(least(greatest(amount, 0), CASE sender % 4 WHEN 0 THEN 130 WHEN 1 THEN 100 WHEN 2 THEN 200 ELSE 0 END) * 100 + 0.5) AS BIGINT) AS health_e2
  FROM f_packets WHERE type IN ('state', 'hit', 'death', 'pickup') AND (type <> 'state' OR (sender % 4 < 3 AND event_id % 13 <> 0))""")
def _(t):
    e = F.col("event_id")
    pose = F.struct((e * 7919 % 12001 - 6000).cast("double").alias("x"), F.lit(1.0).alias("z"), F.when(e % 13 != 0, F.lit(0.5)).alias("heading"))
    vehicle = F.get(F.array(*[F.lit(v) for v in ("interceptor", "raider", "wartruck", "tank")]), (F.col("sender") % 4).cast("int"))
    text = F.to_json(F.struct("type", F.struct(vehicle.alias("vehicle"), pose.alias("pose"), F.col("amount").alias("health")).alias("data")))
    out = pk.valid_packets(pk.parse_packets(t.f_packets.select("event_id", "sender", text.alias("value"))))
    most = F.coalesce("health", F.lit(0.0))
    return out.select("event_id", F.col("x").cast("bigint").alias("x"), half_up(most * 100).alias("health_e2"))


@query("rate_breaches", "SELECT sender, CAST(date_trunc('day', ts) AS VARCHAR) AS start, CAST(count(*) AS BIGINT) AS n FROM f_packets GROUP BY 1, 2 HAVING count(*) > 5")
def _(t):
    return pk.rate_breaches(packets(t), "1 day", 5).select("sender", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


SESSIONS = """WITH f AS (SELECT sender, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS f FROM f_packets WINDOW w AS (PARTITION BY sender ORDER BY ts)), r AS (SELECT *, sum(f) OVER (PARTITION BY sender ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM f)
  SELECT sender, epoch_us(min(ts)) AS start_us, epoch_us(max(ts) + INTERVAL 8 HOUR) AS end_us, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY sender, run"""


def session_rows(df):
    return df.select("sender", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@query("presence_sessions", SESSIONS)
def _(t):
    return session_rows(pk.presence_sessions(packets(t), "8 hours"))


@query("room_roster", """WITH m AS (SELECT room, sender, min({'t': ts, 'e': event_id}) AS j, max(CASE WHEN type = 'state' THEN {'t': ts, 'e': event_id} END) AS l FROM f_packets GROUP BY 1, 2)
  SELECT room, sender, CAST(rn AS INTEGER) AS seat, rn = 1 AS host, l.e AS last_state FROM (SELECT *, row_number() OVER (PARTITION BY room ORDER BY j.t, j.e) AS rn FROM m) q WHERE rn <= 8""")
def _(t):
    return pk.room_roster(packets(t)).select("room", "sender", "seat", "host", "last_state")


# A stay ends 8 hours after its last packet.
STAYS = """(SELECT room, sender, min(ts) AS joined, max(ts) + INTERVAL 8 HOUR AS left_at, CAST(count(*) AS BIGINT) AS n, max(CASE WHEN type = 'state' THEN {'t': ts, 'e': event_id} END) AS l
  FROM (SELECT *, sum(f) OVER (PARTITION BY room, sender ORDER BY ts ROWS UNBOUNDED PRECEDING) AS stay FROM (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS f FROM f_packets WINDOW w AS (PARTITION BY room, sender ORDER BY ts)) q) r GROUP BY room, sender, stay)"""


@query("room_stays", f"SELECT room, sender, epoch_us(joined) AS joined_us, epoch_us(left_at) AS left_us, n, l.e AS last_state FROM {STAYS} s")
def _(t):
    return pk.room_stays(packets(t), "8 hours").select("room", "sender", F.unix_micros("joined").alias("joined_us"), F.unix_micros("left").alias("left_us"), "n", "last_state")


# Host in each stretch between two moments of a room; stretches of one host that meet are a term.
@query("room_hosts", f"""WITH s AS MATERIALIZED (SELECT room, sender, epoch_us(joined) AS a, epoch_us(left_at) AS b FROM {STAYS} q), m AS (SELECT room, tm, lead(tm) OVER (PARTITION BY room ORDER BY tm) AS nxt FROM (SELECT room, a AS tm FROM s UNION SELECT room, b FROM s) u),
  h AS (SELECT m.room, m.tm, m.nxt, arg_min({{'s': s.sender, 'a': s.a}}, {{'a': s.a, 's': s.sender}}) AS host FROM m JOIN s ON s.room = m.room AND s.a <= m.tm AND m.tm < s.b GROUP BY 1, 2, 3),
  g AS (SELECT *, sum(f) OVER (PARTITION BY room ORDER BY tm ROWS UNBOUNDED PRECEDING) AS term FROM (SELECT *, CASE WHEN lag(host) OVER w = host AND lag(nxt) OVER w = tm THEN 0 ELSE 1 END AS f FROM h WINDOW w AS (PARTITION BY room ORDER BY tm)) q)
  SELECT room, host.s AS sender, min(tm) AS since_us, max(nxt) AS until_us FROM g GROUP BY room, host.s, term""")
def _(t):
    return pk.room_hosts(pk.room_stays(packets(t), "8 hours"))


DEATHS = f"SELECT sender, life, event_id FROM (SELECT *, row_number() OVER (PARTITION BY sender, life ORDER BY ts, event_id) AS rn FROM (SELECT *, {K} % 10 AS life FROM f_packets WHERE type = 'death') q) r WHERE rn = 1"


@query("dedupe_deaths", DEATHS)
def _(t):
    return pk.dedupe_deaths(packets(t)).select("sender", "life", "event_id")


@query("batch_hits", """SELECT target, CASE WHEN event_id % 2 = 0 THEN 'guns' ELSE 'flame' END AS weapon, epoch_ms(date_trunc('hour', ts)) AS start_ms, CAST(floor(least(sum(amount), 200) * 100 + 0.5) AS BIGINT) AS amount_e2, CAST(count(*) AS BIGINT) AS hits
  FROM f_packets WHERE type = 'hit' AND amount > 0 GROUP BY 1, 2, 3""")
def _(t):
    return pk.batch_hits(packets(t), "1 hour", 200.0).select("target", "weapon", F.unix_millis("start").alias("start_ms"), half_up(F.col("amount") * 100).alias("amount_e2"), "hits")


@query("interpolate_states", f"""WITH s AS (SELECT sender, event_id, epoch_us(ts) AS t, amount AS x, {K} % 628 / 100.0 AS h FROM f_packets WHERE type = 'state'), l AS (SELECT *, lead(t) OVER w AS nt, lead(x) OVER w AS nx, lead(h) OVER w AS nh FROM s WINDOW w AS (PARTITION BY sender ORDER BY t, event_id)),
  p AS (SELECT sender, event_id AS probe_id, epoch_us(ts) AS pa FROM f_packets WHERE type = 'hit'),
  j AS (SELECT * FROM (SELECT p.probe_id, p.pa, l.*, row_number() OVER (PARTITION BY p.probe_id ORDER BY l.t DESC, l.event_id DESC) AS rn FROM p JOIN l ON l.sender = p.sender AND l.t <= p.pa) q WHERE rn = 1)
  SELECT sender, probe_id, CAST(floor((x + (coalesce(nx, x) - x) * f) * 100 + 0.5) AS BIGINT) AS x_e2, CAST(floor((h + coalesce(atan2(sin(nh - h), cos(nh - h)), 0) * f) * 1000 + 0.5) AS BIGINT) AS h_e3, pa - t > 7200000000 AS stale
  FROM (SELECT *, CASE WHEN nt IS NULL THEN 0 ELSE least(greatest((pa - t) / greatest(1.0, nt - t), 0), 1) END AS f FROM j) z""")
def _(t):
    # Times in microseconds here, so no dialect rounds them.
    p = packets(t)
    states = p.filter("type = 'state'").select("sender", "event_id", F.unix_micros("ts").alias("t_ms"), F.col("amount").alias("x"), (F.col("k") % 628 / 100.0).alias("heading"))
    probes = p.filter("type = 'hit'").select("sender", F.col("event_id").alias("probe_id"), F.unix_micros("ts").alias("at_ms"))
    out = pk.interpolate_states(states, probes, 7200000000)
    return out.select("sender", "probe_id", half_up(F.col("x") * 100).alias("x_e2"), half_up(F.col("heading") * 1000).alias("h_e3"), "stale")


def distances(t, scale):
    from placeloom.operators.scale import spread_row_number
    p = packets(t).select(F.col("sender").alias("viewer"), (F.col("sender") % 7).alias("tile"), "ts", "event_id", (F.col("event_id") * 7919 % scale).cast("double").alias("value"))
    return spread_row_number(p, ["viewer", "tile"], ["ts", "event_id"], "n")


def _replay(step, scale):
    return f"""WITH RECURSIVE s AS (SELECT sender AS viewer, row_number() OVER (PARTITION BY sender ORDER BY ts, event_id) AS n, CAST(event_id * 7919 % {scale} AS DOUBLE) AS v FROM f_packets),
      r AS (SELECT viewer, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS state FROM (SELECT DISTINCT viewer FROM s) d UNION ALL SELECT s.viewer, s.n, CAST({step} AS BIGINT) FROM r JOIN s ON s.viewer = r.viewer AND s.n = r.n + 1) SELECT viewer, n, state FROM r WHERE n > 0"""


@query("lod_levels", _replay("CASE WHEN s.v < CASE WHEN r.state > 0 THEN 69 ELSE 81 END THEN 0 WHEN s.v < CASE WHEN r.state > 1 THEN 119 ELSE 131 END THEN 1 ELSE 2 END", 200))
def _(t):
    return pk.lod_levels(distances(t, 200), ["viewer", "tile"], "n").select("viewer", "n", "state")


@query("interest_tiles", _replay("CASE WHEN s.v < 100 OR (r.state = 1 AND s.v <= 170) THEN 1 ELSE 0 END", 240))
def _(t):
    return pk.interest_tiles(distances(t, 240), ["viewer", "tile"], "n").select("viewer", "n", "state")


@query("stall_detection", """WITH s AS (SELECT sender AS car, CAST(floor(epoch(ts) / 14400) AS BIGINT) AS w, epoch(ts) AS a, event_id, amount FROM f_packets), p AS (SELECT car, w, max(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) = 1 AS blocked, abs(arg_max(amount, a) - arg_min(amount, a)) AS moved, arg_max(amount, a) AS speed FROM s GROUP BY 1, 2),
  f AS (SELECT *, moved < 30 AND (blocked OR abs(speed) < 20) AS stuck FROM p), n AS (SELECT *, sum(CASE WHEN stuck THEN 0 ELSE 1 END) OVER (PARTITION BY car ORDER BY w) AS run FROM f)
  SELECT car, w, stuck, CAST(sum(CASE WHEN stuck THEN 1 ELSE 0 END) OVER (PARTITION BY car, run ORDER BY w) * 4 AS BIGINT) AS stuck_h, moved > 60 AS advanced FROM n""")
def _(t):
    s = packets(t).select(F.col("sender").alias("car"), (F.unix_micros("ts") / 1e6).alias("at_s"), F.col("amount").alias("x"), F.lit(0.0).alias("z"), F.col("amount").alias("speed"), (F.col("event_id") % 3 == 0).alias("blocked"))
    out = pk.stall_detection(s, 14400.0, 30.0, 20.0, 60.0)
    return out.select("car", "w", "stuck", half_up(F.col("stuck_s") / 3600).alias("stuck_h"), "advanced")


# ---------------------------------------------------------------- as streams
def stream(t):
    """The events table as a file stream with a watermark wide enough for its disorder."""
    raw = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    p = raw.selectExpr("event_id", "ts", "user_id AS sender", "user_id % 20 AS room", "CASE event_type WHEN 'view' THEN 'state' WHEN 'click' THEN 'hit' WHEN 'purchase' THEN 'pickup' WHEN 'error' THEN 'death' WHEN 'signup' THEN 'join' ELSE event_type END AS type",
                       "(user_id * 7 + 1) % 150 AS target", "value AS amount", "props")
    return with_fields(p).withWatermark("ts", "60 days")


@query("dedupe_deaths_stream", f"SELECT DISTINCT sender, {K} % 10 AS life FROM f_packets WHERE type = 'death'")
def _(t):
    out = run.run_to_end(t.spark, stream(t), lambda s: pk.dedupe_deaths(s).select("sender", "life", "event_id"), run.fresh(scratch(t)))
    return out.select("sender", "life")


@query("delivery_lateness_stream", f"""WITH p AS (SELECT sender, event_id, ts, {TRAVEL} AS travel FROM f_packets), o AS (SELECT *, min(travel) OVER (PARTITION BY sender ORDER BY ts, event_id) AS offset_ms FROM p)
  SELECT event_id, CAST(offset_ms AS BIGINT) AS offset_ms, CAST(max(travel - offset_ms) OVER (PARTITION BY sender ORDER BY ts, event_id ROWS 39 PRECEDING) AS BIGINT) AS worst_ms FROM o""")
def _(t):
    out = run.run_to_end(t.spark, stream(t), pk.delivery_lateness_stream, run.fresh(scratch(t)))
    return out.select("event_id", F.col("offset_ms").cast("bigint").alias("offset_ms"), F.col("worst_ms").cast("bigint").alias("worst_ms"))


# Packets come in five deliveries of six days; every ninth comes two deliveries late, every fifth of the others one.
LATE = """WITH e AS (SELECT event_id, ts, CAST(coalesce(least(4, greatest(0, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 6) + CASE WHEN event_id % 9 = 0 THEN 2 WHEN event_id % 5 = 0 THEN 1 ELSE 0 END), 0) AS INTEGER) AS delivery FROM f_packets),
  w AS (SELECT delivery, max(max(ts)) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM e GROUP BY delivery),
  l AS (SELECT e.*, coalesce(epoch_us(ts) <= (epoch_ms(top) - 3 * 86400000) * 1000, false) AS late FROM e JOIN w USING (delivery))
  SELECT delivery, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (late) AS BIGINT) AS n_dropped, CAST(count(DISTINCT {'e': event_id, 't': ts}) FILTER (NOT late) AS BIGINT) AS n_kept FROM l GROUP BY delivery"""


@query("late_packets", LATE)
def _(t):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    behind = F.when(F.col("event_id") % 9 == 0, 2).when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    number = F.coalesce(F.least(F.lit(4), F.greatest(F.lit(0), F.floor(day / 6)) + behind), F.lit(0)).cast("int")
    rows = packets(t).select("event_id", "ts", number.alias("delivery"))
    kept, dropped = run.run_deliveries(t.spark, rows, "delivery", lambda s: pk.on_time(s, "3 days"), run.fresh(scratch(t)))
    counts = kept.groupBy("delivery").agg(F.count("*").alias("n_kept"))
    return dropped.join(counts, "delivery", "left").select("delivery", "n_rows", "n_dropped", F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"))
