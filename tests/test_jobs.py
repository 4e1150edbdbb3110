"""Graphs, rasters, sources and streams on small inputs against plain Python."""
import datetime
import glob
import gzip
import hashlib
import json
import math
import os
import heapq
import random
import shutil

from pyspark.sql import functions as F

from placeloom.operators import aggregate, graph, raster, select, windows
from placeloom.sources import elements, files, sinks
from placeloom.streaming import packets as pk, run


def edge_table(spark, edges):
    return spark.createDataFrame([(0, a, b, float(w)) for a, b, w in edges], "place_id int, a long, b long, length double")


def test_components_of_chain_star_and_single(spark):
    edges = [(k, k + 1, 1) for k in range(1, 40)] + [(100, k, 1) for k in range(101, 110)]
    vertices = spark.createDataFrame([(0, k) for k in [*range(1, 41), *range(100, 110), 500]], "place_id int, v long")
    got = {r.v: r.component for r in graph.connected_components(vertices, edge_table(spark, edges)).collect()}
    assert {got[k] for k in range(1, 41)} == {1} and {got[k] for k in range(100, 110)} == {100} and got[500] == 500


def test_shortest_paths_and_routes(spark):
    rng = random.Random(2)
    edges = {(min(a, b), max(a, b)): rng.randint(1, 9) for a, b in ((rng.randint(0, 19), rng.randint(0, 19)) for _ in range(50)) if a != b}
    table = edge_table(spark, [(a, b, w) for (a, b), w in edges.items()])
    source = spark.createDataFrame([(0, 0, 0)], "place_id int, route_id int, v long")
    paths = graph.shortest_paths(table, source)
    got = {r.v: r.dist for r in paths.collect()}
    want, todo = {0: 0.0}, True
    while todo:
        todo = False
        for (a, b), w in edges.items():
            for u, v in ((a, b), (b, a)):
                if u in want and want[u] + w < want.get(v, math.inf):
                    want[v], todo = want[u] + w, True
    assert got == want
    far = max(want, key=lambda v: (want[v], v))
    route = graph.routes(paths, spark.createDataFrame([(0, 0, far)], "place_id int, route_id int, v long")).orderBy("hops").collect()
    assert route[0].v == 0 and route[-1].v == far
    assert all((min(a.v, b.v), max(a.v, b.v)) in edges for a, b in zip(route, route[1:]))


def test_a_chain_of_5000_hops(spark):
    """A chain with a loop in its middle and a short branch: contracted, its rounds don't follow its hops."""
    n = 5000
    edges = [(k, k + 1, 1 + k % 3) for k in range(n)] + [(2000, 9000, 1), (9000, 2002, 1), (n, 9500, 4), (9600, 9601, 1), (9601, 9602, 1), (9602, 9600, 1)]
    table = spark.createDataFrame([(0, a, b, float(w), a // 100) if a < b else (0, b, a, float(w), a // 100) for a, b, w in edges], "place_id long, a long, b long, length double, way_id long").repartition(3)
    at = spark.createDataFrame([(0, 0, 0), (0, 1, 2500)], "place_id long, route_id int, v long")
    paths = graph.shortest_paths(table, at).cache()
    got = {(r.route_id, r.v): (r.dist, r.hops, r.parent) for r in paths.collect()}
    near = {}
    for a, b, w in edges:
        near.setdefault(a, []).append((b, w))
        near.setdefault(b, []).append((a, w))
    for route, source in ((0, 0), (1, 2500)):
        want, heap = {}, [(0.0, 0, -1, source)]
        while heap:
            d, h, p, v = heapq.heappop(heap)
            if v not in want:
                want[v] = (d, h, None if p < 0 else p)
                for w, length in near[v]:
                    heapq.heappush(heap, (d + length, h + 1, v, w))
        assert {v: x for (r, v), x in got.items() if r == route} == want
    target = spark.createDataFrame([(0, 0, 9500), (0, 1, 2500)], "place_id long, route_id int, v long")
    route = graph.routes(paths, target).cache()
    walk = [r.v for r in route.filter("route_id = 0").orderBy("hops").collect()]
    assert walk[0] == 0 and walk[-1] == 9500 and len(walk) == n + 2 == got[0, 9500][1] + 1 and 9000 in walk
    summary = {r.route_id: r for r in graph.route_summary(route, table).collect()}
    assert (summary[0].source, summary[0].target, summary[0].junctions, summary[0].length) == (0, 9500, n + 2, got[0, 9500][0])
    way = {frozenset(e[:2]): e[0] // 100 for e in edges}
    roads = [way[frozenset(leg)] for leg in zip(walk, walk[1:])]
    assert summary[0].roads == 1 + sum(a != b for a, b in zip(roads, roads[1:])) and (summary[1].junctions, summary[1].roads) == (1, 0)


def test_fill_and_blur_keep_a_constant(spark):
    rows = [(0, j, i, None if (i, j) in ((3, 3), (3, 4), (0, 0)) else 7.0) for j in range(8) for i in range(8)]
    df = spark.createDataFrame(rows, "place_id int, j int, i int, z double")
    out = windows.raster_blur(raster.raster_mask_fill(df).select("place_id", "j", "i", "z"), 1.0)
    assert all(abs(r.z - 7.0) < 1e-9 for r in out.collect()) and out.count() == 64


def test_coast_water_is_on_the_right(spark):
    """A coast from west to east at y = -150 in a 600 m square: the sea is the strip south of it."""
    places = spark.createDataFrame([(0,)], "place_id int")
    coast = spark.createDataFrame([(0, 1, 0, -400.0, -150.0, 400.0, -150.0)], "place_id int, line_id long, seq int, x1 double, y1 double, x2 double, y2 double")
    cells = raster.place_cells(places, 300.0, 10.0)
    none = cells.limit(0)
    out = raster.land_water(cells, coast, none, none, none, 10.0, 50.0).groupBy("kind").count().collect()
    assert {r.kind: r["count"] * 100 for r in out} == {"sea": 600 * 150, "land": 600 * 450}


def test_greedy_spacing_equals_sequential(spark):
    rng = random.Random(9)
    pts = [(0, k, rng.uniform(0, 100), rng.uniform(0, 100), rng.random()) for k in range(80)]
    df = spark.createDataFrame(pts, "place_id int, id long, x double, y double, w double")
    got = [r.id for r in select.spaced_selection(df.repartition(5), ["place_id"], [F.col("w")], "id", 15.0, 12).orderBy("pick_no").collect()]
    took = []
    for _, k, x, y, _w in sorted(pts, key=lambda p: (p[4], p[1])):
        if all(math.hypot(x - a, y - b) >= 15.0 for _k, a, b in took):
            took.append((k, x, y))
    assert got == [k for k, *_ in took][:12]


def test_greedy_cover_takes_the_widest_view_first(spark):
    seen = spark.createDataFrame([(0, v, b, 5.0) for v, bs in {1: [1, 2, 3], 2: [3, 4], 3: [4, 5], 4: [1]}.items() for b in bs], "place_id int, view long, b_id long, distance double")
    got = [(r.view, r.gain) for r in select.greedy_cover(seen, ["view"], 5).orderBy("round_no").collect()]
    assert got == [(1, 3), (3, 2)]


def test_topology_without_roads(spark):
    from placeloom.operators.aggregate import topology_status
    places = spark.createDataFrame([(0,), (1,)], "place_id int")
    roads = spark.createDataFrame([(1, True)], "place_id int, usable boolean")
    assert {r.place_id: r.topology for r in topology_status(roads, places).collect()} == {0: "none", 1: "osm_nodes"}


def test_read_elements_from_json_and_gzip(spark, tmp_path):
    doc = {"elements": [{"type": "node", "id": 1, "lat": 50.0, "lon": 10.0, "tags": {"natural": "tree"}}, {"type": "node", "id": 2},
                        {"type": "way", "id": 3, "tags": {"highway": "path"}, "nodes": [1, 2], "geometry": [{"lat": 50.0, "lon": 10.0}]}, {"type": "way", "id": 4, "tags": {}},
                        {"type": "relation", "id": 5, "tags": {}, "members": [{"type": "way", "ref": 3, "role": "outer"}]}]}
    (tmp_path / "here.json").write_text(json.dumps(doc))
    with gzip.open(tmp_path / "there.json.gz", "wt") as f:
        f.write(json.dumps(doc))
    parts = elements.read_elements(spark, str(tmp_path))
    assert {k: v.count() for k, v in parts.items()} == {"ways": 2, "relations": 2, "nodes": 2}
    assert {r.place for r in parts["ways"].collect()} == {"here", "there"}


def test_gzip_content_is_verified(spark):
    plain = b"hello" * 100
    packed = gzip.compress(plain)
    have = spark.createDataFrame([("a.gz", bytearray(packed)), ("b.gz", bytearray(b"junk"))], "name string, content binary")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = spark.createDataFrame([("a.gz", sha(packed), len(packed), sha(plain), len(plain)), ("b.gz", sha(b"junk"), 4, sha(b""), 0)], "name string, stored_sha256 string, stored_bytes long, sha256 string, bytes long")
    assert {r.name: r.verdict for r in files.verify_files(have, want).collect()} == {"a.gz": "ok", "b.gz": "unreadable"}


def test_legacy_text(spark):
    df = spark.createDataFrame([(1, bytearray("Borås €".encode("cp1252"))), (2, bytearray("Borås €".encode()))], "id long, content binary")
    assert {(r.id, r.encoding, r.text) for r in files.decode_text(df).collect()} == {(1, "cp1252", "Borås €"), (2, "utf-8", "Borås €")}


def test_fingerprint_ignores_order_and_partitions(spark):
    from placeloom.operators.audit import dataset_fingerprint
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("v"))
    one = dataset_fingerprint(df.repartition(1)).first()
    assert one == dataset_fingerprint(df.orderBy(F.col("id").desc()).repartition(9)).first()
    assert one != dataset_fingerprint(df.withColumn("v", F.when(F.col("id") == 3, 99).otherwise(F.col("v")))).first()


def test_canonical_output_is_the_same_for_shuffled_input(spark, tmp_path):
    df = spark.range(200).select(F.col("id"), (F.col("id") * 3).alias("b"), F.lit("x").alias("a"))
    texts = []
    for k, d in enumerate((df, df.repartition(7).orderBy(F.rand(1)))):
        sinks.write_canonical(d, str(tmp_path / str(k)), "id")
        texts.append("".join(p.read_text() for p in sorted((tmp_path / str(k)).glob("part-*"))))
    assert texts[0] == texts[1] and texts[0].startswith('{"a":"x","b":0,"id":0}')


# ---------------------------------------------------------------- streams: equal to their batch twins over split files
def split_events(spark, folder, n=4):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id", "CAST(ts AS timestamp) AS ts", "user_id AS sender", "user_id % 20 AS room", "event_type", "value AS amount", "props")
    ev = ev.withColumns({"travel_ms": F.get_json_object("props", "$.k").cast("bigint") * 3, "type": F.when(F.col("event_type") == "view", "state").otherwise("hit"), "weapon": F.lit("guns"), "target": F.col("sender") % 5})
    ev.repartitionByRange(n, "ts").sortWithinPartitions("ts").write.parquet(folder)
    # A file stream takes files by age: make that the order of time.
    for k, path in enumerate(sorted(glob.glob(f"{folder}/part-*"))):
        os.utime(path, (1000000 + k, 1000000 + k))
    return spark.read.parquet(folder)


def test_windows_on_a_stream_equal_batch(spark, tmp_path):
    batch = split_events(spark, str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).withWatermark("ts", "40 days")
    for name, build in {"rate": lambda d: pk.rate_breaches(d, "1 day", 1), "sessions": lambda d: pk.presence_sessions(d, "8 hours"), "hits": lambda d: pk.batch_hits(d, "1 hour", 200.0)}.items():
        query = build(source()).writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination()
        assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, build(batch).collect())), name


def test_lateness_state_over_files_equals_batch(spark, tmp_path):
    batch = split_events(spark, str(tmp_path / "in"))
    source = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = run.run_to_end(spark, source, pk.delivery_lateness_stream, str(tmp_path / "run"))
    want = windows.delivery_lateness(batch, "sender", ["ts", "event_id"])
    got = {r.event_id: (int(r.offset_ms), int(r.worst_ms), int(r.delay_ms)) for r in out.collect()}
    assert got == {r.event_id: (r.offset_ms, r.worst_ms, r.delay_ms) for r in want.collect()}


def test_roster_and_hysteresis_streams(spark, tmp_path):
    batch = split_events(spark, str(tmp_path / "in"))
    spark.conf.set(run.PROVIDER, run.ROCKSDB)
    source = lambda: spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = pk.room_roster_stream(source()).writeStream.format("memory").queryName("roster").outputMode("update").option("checkpointLocation", str(tmp_path / "r")).trigger(availableNow=True).start()
    q.awaitTermination()
    want = {(r.room, r.sender, r.seat, r.last_state) for r in pk.room_roster(batch).collect()}
    assert {(r.room, r.sender, r.seat, r.last_state) for r in spark.table("roster").collect()} == want
    samples = lambda d: d.selectExpr("sender AS viewer", "sender % 7 AS tile", "event_id AS n", "CAST(event_id * 7919 % 200 AS DOUBLE) AS value")
    q = pk.hysteresis_stream(samples(source()), "lod").writeStream.format("memory").queryName("lod").outputMode("append").option("checkpointLocation", str(tmp_path / "l")).trigger(availableNow=True).start()
    q.awaitTermination()
    states, want = {}, {}
    for r in samples(batch).orderBy("n").collect():
        states[r.viewer] = pk.next_level(states.get(r.viewer, 0), r.value)
        want[(r.viewer, r.n)] = states[r.viewer]
    assert {(r.viewer, r.n): r.level for r in spark.table("lod").collect()} == want


def test_long_hysteresis_run_is_split(spark):
    values = [k * 7919 % 200 for k in range(5000)]
    df = spark.createDataFrame([(1, 2, k, float(v)) for k, v in enumerate(values)], "viewer long, tile long, n long, value double").repartition(6)
    state, want = 0, []
    for v in values:
        state = pk.next_level(state, v)
        want.append(state)
    assert [r.state for r in pk.lod_levels(df, ["viewer", "tile"], "n").orderBy("n").collect()] == want


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    """Lateness is judged by the watermark of the batch before, hence the quiet batch in between."""
    rows = lambda ts: spark.createDataFrame([(k, t) for k, t in enumerate(ts)], "event_id long, t string").selectExpr("event_id", "CAST(t AS timestamp) AS ts", "1L AS sender")
    for k, ts in enumerate((["2024-01-01 00:00:00", "2024-01-01 12:00:00"], ["2024-01-03 00:00:00"], ["2024-01-03 01:00:00"], ["2024-01-01 01:00:00"], ["2024-01-05 00:00:00"])):
        rows(ts).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{k}"))
    (tmp_path / "all").mkdir()
    for k in range(5):
        for n, p in enumerate(sorted((tmp_path / f"in{k}").glob("*.parquet"))):
            shutil.copy(p, tmp_path / "all" / f"{k}-{n}.parquet")
            os.utime(tmp_path / "all" / f"{k}-{n}.parquet", (1000 + k, 1000 + k))
    src = spark.readStream.schema("event_id long, ts timestamp, sender long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "all")).withWatermark("ts", "1 hour")
    q = pk.rate_breaches(src, "1 day", 0).writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    counts = {str(r.start)[:10]: r.n for r in spark.table("late").collect()}
    assert counts["2024-01-01"] == 2


def test_deliveries_count_late_rows(spark, tmp_path):
    shape = "event_id long, ts timestamp, delivery int"
    day = lambda d: datetime.datetime(2024, 1, d)
    rows = [(1, day(10), 0), (1, day(10), 0), (2, day(2), 0), (3, day(1), 1), (4, day(9), 1), (5, day(20), 1), (6, day(10), 3), (7, day(17), 3), (8, day(18), 3), (2, day(2), 3)]
    kept, counts = run.run_deliveries(spark, spark.createDataFrame(rows, shape), "delivery", lambda s: pk.on_time(s, "3 days"), str(tmp_path / "a"))
    # The mark is three days before the latest time of earlier deliveries: none, the 7th, the 17th; a time on the mark is late.
    assert sorted(r.event_id for r in kept.collect()) == [1, 2, 4, 5, 8]
    assert sorted(map(tuple, counts.collect())) == [(0, 3, 0), (1, 3, 1), (3, 4, 3)]
    kept, counts = run.run_deliveries(spark, spark.createDataFrame([], shape), "delivery", lambda s: pk.on_time(s, "3 days"), str(tmp_path / "b"))
    assert kept.count() == counts.count() == 0


def test_similarity_fit_about_the_origin(spark):
    turn, grow = 0.1, 1.5
    turned = [(1, x, y, grow * (x * math.cos(turn) - y * math.sin(turn)), grow * (x * math.sin(turn) + y * math.cos(turn))) for x, y in ((3.0, 4.0), (7.0, -2.0), (10.0, 11.0))]
    rows = [*turned, (2, 0.0, 0.0, 0.3, 0.4), (3, 5.0, 5.0, 5.0, 5.0)]
    pairs = spark.createDataFrame(rows, "place_id int, x double, y double, u double, v double")
    got = {r.place_id: r for r in aggregate.similarity_fit(pairs, ["place_id"], {"max_residual": 1.0, "scale_deviation": 0.01}).collect()}
    assert math.isclose(got[1].rotation, turn) and math.isclose(got[1].scale, grow) and not got[1].passed
    assert math.isclose(got[1].mean_residual, sum(math.hypot(u - x, v - y) for _, x, y, u, v in turned) / 3)
    assert got[2].scale is None and not got[2].passed and math.isclose(got[2].max_residual, 0.5)
    assert got[3].passed and got[3].scale == 1


def test_members_leave_rooms_on_a_stream(spark, tmp_path):
    at = lambda h, m=0: datetime.datetime(2024, 1, 1, h, m)
    rows = [(1, at(0), 1, 7, "join", 0), (2, at(0, 5), 1, 7, "state", 0), (3, at(0, 2), 1, 8, "state", 0), (4, at(0, 2), None, 8, "hit", 0), (5, at(3), 1, 9, "state", 1), (6, at(3, 1), 1, 7, "hit", 1),
            (7, at(6), 1, 9, "hit", 2), (8, at(6, 4), 2, 7, "state", 2), (9, None, 2, 7, "state", 2)]
    packets = spark.createDataFrame(rows, "event_id long, ts timestamp, room long, sender long, type string, delivery int")
    batch = [tuple(r) for r in pk.room_stays(packets, "10 minutes").collect()]
    assert (1, 7, at(0), at(0, 15), 2, 2) in batch and (None, 8, at(0, 2), at(0, 12), 1, None) in batch and len(batch) == 7
    out, counts = run.run_deliveries(spark, packets, "delivery", lambda s: pk.room_stays(s.withWatermark("ts", "5 minutes"), "10 minutes"), str(tmp_path / "a"), state_rows="held")
    # Who sent at three is gone at six; only those who sent last are still held.
    text = lambda rows: sorted(map(str, rows))
    assert text(tuple(r) for r in out.collect()) == text(r for r in batch if r[2] < at(6))
    assert [(r.delivery, r.held) for r in counts.orderBy("delivery").collect()] == [(0, 3), (1, 2), (2, 2)]
    stays = spark.createDataFrame([(1, 5, at(1), at(4)), (1, 6, at(1), at(3)), (1, 7, at(2), at(9)), (1, 8, at(3), at(8)), (1, 5, at(10), at(11))], "room long, sender long, joined timestamp, left timestamp")
    us = lambda d: int(d.timestamp() * 1e6)
    assert sorted(map(tuple, pk.room_hosts(stays).collect())) == sorted([(1, 5, us(at(1)), us(at(4))), (1, 7, us(at(4)), us(at(9))), (1, 5, us(at(10)), us(at(11)))])
    assert pk.room_hosts(stays.limit(0)).count() == 0
