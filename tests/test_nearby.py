import datetime as dt
import math
import random

from surveyloom.operators import nearby as N
from surveyloom.operators import regions as G
from surveyloom.plans.matching import clean_fish, fish_sample_match
from tests.conftest import plan, rows

LEFT = "fishid int, date date, sal double, lat double, long double"
RIGHT = "r_id int, r_date date, r_sal double, r_lat double, r_long double"
DAY = dt.date(2015, 6, 1)


def km(a, b, c, d):
    p = math.radians
    h = math.sin(p(c - a) / 2) ** 2 + math.cos(p(a)) * math.cos(p(c)) * math.sin(p(d - b) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


def make(spark, left, right):
    return spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)


def brute(left, right, limits):
    return sorted((
        (a[0], b[0]) for a in left for b in right
        if km(a[3], a[4], b[3], b[4]) <= limits.radius_km
        and (limits.days is None or abs((a[1] - b[1]).days) <= limits.days)
        and (limits.salinity is None or (a[2] <= b[2] + limits.salinity and a[2] >= b[2] - limits.salinity))
    ), key=repr)


def cloud(seed, n, lat, lon, spread):
    rnd = random.Random(seed)
    wrap = lambda x: (x + 180) % 360 - 180
    return [
        (i, DAY + dt.timedelta(days=rnd.randrange(90)), round(rnd.random() * 6, 1),
         lat + rnd.uniform(-spread, spread), wrap(lon + rnd.uniform(-spread, spread) / math.cos(math.radians(lat))))
        for i in range(n)
    ]


def test_pairs_equal_brute_force_everywhere(spark):
    left, right = [], []
    for k, (lat, lon) in enumerate([(38, -122), (0, 179.99), (-75, 180), (89.95, 10)]):
        left += [(1000 * k + r[0], *r[1:]) for r in cloud(k, 25, lat, lon, 0.03)]
        right += [(1000 * k + r[0], *r[1:]) for r in cloud(k + 50, 25, lat, lon, 0.03)]
    frames = make(spark, left, right)
    for limits in (N.Limits(2, 15, 1), N.Limits(2, None, None)):
        found = N.pairs_within(*frames, limits)
        assert rows(found, "fishid", "r_id") == brute(left, right, limits)
    executed = plan(found)
    assert "NestedLoop" not in executed and "Cartesian" not in executed


def test_crowded_bucket_is_split_without_loss(spark):
    left, right = cloud(1, 30, 38, -122, 0.01), cloud(2, 120, 38, -122, 0.005)
    frames = make(spark, left, right)
    found = N.pairs_within(*frames, N.Limits(2, 15, 1), rows_per_chunk=7)
    assert rows(found, "fishid", "r_id") == brute(left, right, N.Limits(2, 15, 1))


def test_limits_are_inclusive_and_missing_salinity_drops(spark):
    step = lambda d: d / 6371.0088 * 180 / math.pi
    left = [(1, DAY, 2.0, 38.0, -122.0)]
    right = [
        (1, DAY + dt.timedelta(days=15), 3.0, 38.0 + step(1.99), -122.0), (2, DAY, 2.0, 38.0 + step(2.01), -122.0),
        (3, DAY + dt.timedelta(days=16), 2.0, 38.0, -122.0), (4, DAY - dt.timedelta(days=15), 1.0, 38.0, -122.0),
        (5, DAY, None, 38.0, -122.0), (6, DAY, 3.01, 38.0, -122.0), (7, DAY, 2.0, None, -122.0),
    ]
    assert rows(N.pairs_within(*make(spark, left, right), N.Limits()), "r_id") == [(1,), (4,)]


def test_places_stand_for_all_pairs(spark):
    left = [(i, DAY, 1.0, 38.0, -122.0) for i in range(4)] + [(9, DAY, 1.0, 39.0, -122.0)]
    df = spark.createDataFrame(left, LEFT)
    out = N.places_within(df, df.select("lat", "long"), 2.0)
    assert rows(out, "N_left", "N_right", "N_pairs") == [(1, 1, 1), (4, 4, 16)]


def test_fish_cleaning_and_output_shape(spark):
    fish = spark.createDataFrame([("f1", "TNS", "06/01/2015", 2.0, 38.0, -122.0), ("f2", "EMP", "junk", 2.0, 38.0, -122.0)],
                                 "fishid string, survey string, date string, sal double, lat double, long double")
    env = spark.createDataFrame([("s1", "A", DAY, 38.0, -122.0, 1.5, 2.5)],
                                "SampleID string, Station string, Date date, Latitude double, Longitude double, SalSurf double, SalBott double")
    out = fish_sample_match(clean_fish(fish), env)
    row = out.collect()
    assert len(row) == 1 and row[0]["smelt_survey"] == "STN" and row[0]["zoop_ID"] == "s1" and row[0]["zoop_sal_avg"] == 2.0


def test_match_of_a_synthesis_has_all_columns_or_fails(spark):
    import pytest

    from surveyloom.plans.matching import FISH_COLUMNS, SAMPLE_COLUMNS, match_synthesis
    from tests.test_synth import TWO, frames

    catch, env = frames(spark, TWO, {"b1": 2005})
    env = env.selectExpr("*", "1D AS SalBott")
    fish = spark.createDataFrame([("f1", "TNS", "05/03/2000", "x", 1.5, 9.0, 8.0, 38.0, -122.0), ("f2", "A", "05/03/2005", "x", 1.5, 9.0, 8.0, 38.0, -122.0)],
                                 "fishid string, survey string, date string, station string, sal double, secchi double, temp double, lat double, long double")
    pairs, caught = match_synthesis(fish, catch, env, ("2000-01-01", "2001-01-01"))
    assert pairs.columns == [*FISH_COLUMNS.values(), *SAMPLE_COLUMNS.values()] and len(pairs.columns) == 15
    assert rows(pairs, "smelt_ID", "smelt_survey", "smelt_date", "zoop_ID") == [("f1", "STN", dt.date(2000, 5, 3), "a1")]
    assert {r[0] for r in rows(caught, "SampleID")} == {"a1"} and caught.filter("Taxatype = 'Taxon'").count() == 3
    with pytest.raises(ValueError, match="secchi"):
        match_synthesis(fish.drop("secchi"), catch, env)


def test_concave_region_default_and_missing(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    regions = spark.createDataFrame([("U", ring)], G_SCHEMA)
    points = spark.createDataFrame([(1, 0.5, 2.0), (2, 3.0, 2.0), (3, 3.0, 0.2), (4, 9.0, 9.0), (5, None, 1.0)], "id int, Latitude double, Longitude double")
    out = rows(G.assign_regions(points, regions, "Out"), "id", "Region")
    assert out == [(1, "U"), (2, "Out"), (3, "U"), (4, "Out"), (5, None)]


G_SCHEMA = "Region string, ring array<struct<lon: double, lat: double>>"


def test_hull_of_square_with_inner_and_collinear_points(spark):
    corners = {(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)}
    inner = [(2.0, 0.0), (0.0, 2.0), (1.0, 1.0), (3.0, 2.0), (4.0, 2.0)]
    data = [("a", x, y) for x, y in [*corners, *inner] * 3] + [("b", 1.0, 1.0), (None, 2.0, 2.0)]
    df = spark.createDataFrame(data, "g string, Longitude double, Latitude double").repartition(5)
    out = rows(G.hull_by_group(df, "g"))
    assert {(x, y) for g, x, y in out if g == "a"} == corners
    assert [r for r in out if r[0] != "a"] == [("b", 1.0, 1.0), (None, 2.0, 2.0)]


def test_hull_keeps_flat_corners_and_only_corners(spark):
    ring = [(math.cos(k * math.pi / 12) * 1e-5 + 3, math.sin(k * math.pi / 12) * 1e-5 + 4) for k in range(24)]
    bent = [(float(x), x * x * 1e-13) for x in range(-9, 10)]
    line = [(0.1 * k, 0.1 * k) for k in range(30)]
    data = [("ring", *p) for p in ring * 3] + [("bent", *p) for p in bent] + [("line", *p) for p in line]
    df = spark.createDataFrame(data, "g string, Longitude double, Latitude double").repartition(5)
    out = rows(G.hull_by_group(df, "g"))
    assert {r[1:] for r in out if r[0] == "ring"} == set(ring) and {r[1:] for r in out if r[0] == "bent"} == set(bent)
    assert {r[1:] for r in out if r[0] == "line"} == {line[0], line[-1]}


def even_odd(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def test_parts_holes_and_islands_by_cells(spark):
    rnd = random.Random(12)
    star = lambda cx, cy, r, n: [(cx + r * (0.4 + rnd.random()) * math.cos(2 * math.pi * k / n), cy + r * (0.4 + rnd.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    square = lambda x, y, r: [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r)]
    shapes = {"A": [star(0, 0, 2, 40), star(3.3, 1, 1, 9)], "B": [square(-3, -3, 1.0), square(-3, -3, 0.5), square(-3, -3, 0.25)], "C": [star(0.4, 3, 0.1, 7)]}
    regions = spark.createDataFrame(list(shapes.items()), "Region string, rings array<array<struct<lon: double, lat: double>>>")
    places = [(rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for _ in range(3000)] + [(x / 4, y / 4) for x in range(-18, 19) for y in range(-18, 19)]
    df = spark.createDataFrame([(y, x) for x, y in places], "Latitude double, Longitude double")
    want = {(y, x): min((n for n, rings in shapes.items() if even_odd(rings, x, y)), default="none") for x, y in places}
    for cell in (0.25, 0.3, 2.0):
        got = {(r["Latitude"], r["Longitude"]): r["Region"] for r in G.region_of_places(df, regions, "none", cell).collect()}
        assert got == want
    cells = G.region_cells(regions, 0.05)
    assert cells.filter("_edges IS NULL").count() > 1000
    # Cells inside hold no edges, those on the boundary only the ones of their row.
    assert cells.agg({"_odd": "count"}).first()[0] > 0 and cells.selectExpr("max(size(_edges))").first()[0] < 20


def test_lookups_of_many_bytes_are_not_broadcast(spark, monkeypatch):
    from surveyloom import session

    left = spark.createDataFrame([(k % 5, k) for k in range(50)], "k int, v int")
    right = spark.createDataFrame([(k, f"name {k}") for k in range(5)], "k int, name string")
    within = rows(session.join_lookup(left, right, ["k"]))
    assert "BroadcastHashJoin" in plan(session.join_lookup(left, right, ["k"]))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 10)
    wide = session.join_lookup(left, right, ["k"])
    assert "_slice" in plan(wide) and rows(wide) == within


def test_crop_to_box(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0)], "id int, Latitude double, Longitude double")
    frame = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0)], "Latitude double, Longitude double")
    assert rows(N.crop_to(points, frame), "id") == [(1,)]


def test_unrolled_side_is_not_broadcast(spark):
    frames = make(spark, cloud(1, 30, 38, -122, 0.01), cloud(2, 120, 38, -122, 0.005))
    executed = plan(N.pairs_within(*frames, N.Limits(2, 15, 1))).split("== Physical Plan ==")[1]
    assert "SortMergeJoin" in executed and "Broadcast" not in executed


def test_distance_is_computed_once_for_samples_of_a_place_and_day(spark):
    left = spark.createDataFrame([(k, DAY, 2.0, 38.0, -122.0) for k in range(3)], LEFT)
    right = spark.createDataFrame([(k, DAY + dt.timedelta(days=k % 2), 1.0 + k % 5 / 2, 38.0, -122.001) for k in range(40)], RIGHT)
    for limits in (N.Limits(2, 15, 1), N.Limits(2, 15, None), N.Limits(2, None, None)):
        found = N.pairs_within(left, right, limits, digits=3)
        assert found.columns == [*left.columns, *right.columns, "km"]
        assert rows(found, "fishid", "r_id") == brute(left.collect(), right.collect(), limits)
        assert {r["km"] for r in found.collect()} == {round(km(38.0, -122.0, 38.0, -122.001), 3)}
        steps = plan(found).split("== Physical Plan ==")[1]
        # Lists unroll above the join and above the distance.
        assert steps.index("Generate explode(_") < steps.index("ASIN") < steps.index("SortMergeJoin")


def test_pairs_come_out_by_list_and_left_row(spark):
    left = spark.createDataFrame([(k, DAY, 2.0, 38.0, -122.0) for k in range(6)], LEFT)
    right = spark.createDataFrame([(k, DAY + dt.timedelta(days=k % 2), 2.0, 38.0, -122.0) for k in range(20)], RIGHT).repartition(4)
    out = [(r["r_date"], r["fishid"]) for r in N.pairs_within(left, right, N.Limits(2, 15, 1)).collect()]
    changes = sum(a != b for a, b in zip(out, out[1:]))
    assert len(out) == 120 and changes == 11  # twelve runs of ten, however the samples arrive


def test_many_rows_of_one_bucket_are_split_also_where_the_other_side_has_few(spark):
    from surveyloom.session import stage

    left, right = make(spark, [(1, DAY, 2.0, 38.0, -122.0)], [(k, DAY, 2.0, 38.0, -122.0) for k in range(60)])
    keyed = lambda df: stage(df.selectExpr("*", "1 AS k"), "bucket")
    a, b, keys, pairs = N.split_crowded(keyed(left), keyed(right), ["k"], rows_per_chunk=10)
    assert pairs == 60 and keys == ["k", "_chunk_l", "_chunk_r"]
    assert b.select("_chunk_r").distinct().count() > 3 and a.count() == 6 and b.count() == 60
    assert rows(N.pairs_within(left, right, N.Limits(2, 15, 1), rows_per_chunk=10), "r_id") == sorted([(k,) for k in range(60)], key=repr)


def test_match_makes_its_synthesis_once_and_moves_only_fish_in_reach(spark, monkeypatch):
    from surveyloom.plans import matching
    from tests.test_synth import TWO, frames

    catch, env = frames(spark, TWO, {"b1": 2005})
    env = env.selectExpr("*", "1D AS SalBott")
    days = ["04/16/2000", "04/15/2000", "05/16/2000", "05/17/2000", "junk", None]
    fish = spark.createDataFrame([(f"f{k}", "A", d, "x", 1.5, 9.0, 8.0, 38.0, -122.0) for k, d in enumerate(days)],
                                 "fishid string, survey string, date string, station string, sal double, secchi double, temp double, lat double, long double")
    labels, reached = [], []
    stage, match = matching.stage, matching.fish_sample_match
    monkeypatch.setattr(matching, "stage", lambda df, label: labels.append(label) or stage(df, label))
    monkeypatch.setattr(matching, "fish_sample_match", lambda fish, *a, **k: reached.append(fish) or match(fish, *a, **k))
    period = ("2000-05-01", "2000-05-01")
    pairs, _ = matching.match_synthesis(fish, catch, env, period)
    assert labels == ["samples"] and {r[0] for r in rows(reached[0], "fishid")} == {"f0", "f2"}
    assert rows(pairs, "smelt_ID", "zoop_ID") == [("f0", "a1"), ("f2", "a1")]
    assert matching.within_reach(fish, None, N.Limits()).count() == 6 == matching.within_reach(fish, period, N.Limits(days=None)).count()
    cleaned = clean_fish(fish)
    assert matching.within_reach(cleaned, ("2000-05-01", None), N.Limits()).count() == 3
    assert matching.within_reach(cleaned, (None, "2000-05-01"), N.Limits()).count() == 3
