"""Grid cuts against brute force, with and without broadcasts, and their delivery."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from barograph.operators import joins, subset
from barograph.operators.requests import date_ranges, request_grid, skip_existing
from barograph.plans import plan_requests, recorded_ledger, report_run, run_requests
from barograph.sinks import delivered_units, delivery_record, read_grid, read_units, write_grid
from barograph.sinks.grids import morton_key

GRID = "variable string, valid_time timestamp_ntz, lat double, lon double, value double"
BOXES = "region string, north double, west double, south double, east double"


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def points(spark):
    draw = random.Random(7)
    rows = [
        ("tp" if i % 3 else "2t", at(f"2024-0{1 + i % 4}-1{i % 9} 00:00:00"),
         draw.choice([11.0, 19.0, draw.uniform(-90, 90)]), draw.choice([74.0, 79.0, draw.uniform(-180, 180)]),
         float(i))
        for i in range(3000)
    ]
    # A third of all points are copies of one another.
    rows += [("tp", at("2024-01-10 00:00:00"), 12.5, 75.5, -1.0)] * 1500
    return rows


@pytest.fixture(scope="module")
def boxes():
    draw = random.Random(8)
    rows = [("ka", 19.0, 74.0, 11.0, 79.0), ("tn", 14.0, 76.0, 8.0, 81.0), ("flip", 10.0, 20.0, 0.0, -20.0),
            ("all", 90.0, -180.0, -90.0, 180.0), ("dot", 11.0, 74.0, 11.0, 74.0)]
    for i in range(40):
        south, west = draw.uniform(-90, 80), draw.uniform(-180, 170)
        rows.append((f"r{i}", south + draw.uniform(0, 10), west, south, west + draw.uniform(0, 10)))
    return rows


def inside(point, box):
    return box[3] <= point[2] <= box[1] and box[2] <= point[3] <= box[4]


def test_box_edges(spark):
    rows = [(lat, lon) for lat in (10.9, 11.0, 15.0, 19.0, 19.1) for lon in (73.9, 74.0, 79.0, 79.1)]
    grid = spark.createDataFrame([("v", at("2024-01-01"), lat, lon, 0.0) for lat, lon in rows], GRID)
    kept = {(r["lat"], r["lon"]) for r in subset.box_filter(grid, [19, 74, 11, 79]).collect()}
    assert kept == {(lat, lon) for lat, lon in rows if 11 <= lat <= 19 and 74 <= lon <= 79}


@pytest.mark.parametrize("small", [None, True, False])
def test_region_assign(spark, points, boxes, small):
    grid, regions = spark.createDataFrame(points, GRID), spark.createDataFrame(boxes, BOXES)
    found = subset.region_assign(grid, regions, small=small).select("region", "value").collect()
    expected = sorted((box[0], point[4]) for point in points for box in boxes if inside(point, box))
    assert sorted(map(tuple, found)) == expected
    assert subset.region_assign(grid, regions.limit(0), small=small).count() == 0


def test_region_assign_plans(spark, points, boxes, plan):
    grid, regions = spark.createDataFrame(points, GRID), spark.createDataFrame(boxes, BOXES)
    small, large = (plan(subset.region_assign(grid, regions, small=n)) for n in (None, False))
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small
    assert "ResolvedHint (strategy=broadcast)" not in large
    assert "NestedLoop" not in small + large and "Cartesian" not in small + large


def test_large_sides_are_not_broadcast(spark, points, boxes, plan, monkeypatch):
    """What is not proven small is shuffled, whatever Spark estimates; many regions of few boxes meet points by box."""
    shared = [(f"{b[0]}-{i}", *b[1:]) for b in boxes for i in range(20)]
    grid, regions = spark.createDataFrame(points, GRID), spark.createDataFrame(shared, BOXES)
    assert "BroadcastHashJoin" not in plan(subset.region_assign(grid, regions, small=False))
    monkeypatch.setattr(subset, "MAX_BROADCAST_ROWS", subset.CELLS_PER_BOX * len(boxes))
    found = subset.region_assign(grid, regions)
    text = plan(found).split("== Physical Plan ==")[1]
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1
    assert found.columns == subset.region_assign(grid, regions, small=True).columns
    rows = sorted(map(tuple, found.select("region", "value", "north").collect()))
    assert rows == sorted((b[0], p[4], b[1]) for p in points for b in shared if inside(p, b))


MIXED = {
    "ten thousand boxes of a hundredth of a degree within one degree": 0,
    "the same beside two hundred boxes of the whole globe": 200,
}


@pytest.mark.parametrize("globes", MIXED.values(), ids=MIXED)
def test_boxes_of_mixed_size(spark, globes):
    """A point looks at the boxes around it, whatever other boxes there are."""
    draw = random.Random(globes)
    boxes = [(f"s{i}", lat + 0.01, lon, lat, lon + 0.01) for i in range(10_000) for lat, lon in [(10 + draw.random(), 70 + draw.random())]]
    boxes += [(f"g{i}", 90.0, -180.0, -90.0, 180.0) for i in range(globes)]
    cells = subset.box_cells(spark.createDataFrame(boxes, BOXES))
    assert cells.count() <= subset.CELLS_PER_BOX * len(boxes)
    met = cells.groupBy("_level", "_lat", "_lon").count().groupBy("_level").agg(F.max("count").alias("most"))
    most = {r["_level"]: r["most"] for r in met.collect()}
    # One box in expectation holds a point; a cell meets the boxes within about three of their widths.
    assert sum(most.values()) <= 25 + globes
    grid = [("v", at("2024-01-01"), 10 + draw.random(), 70 + draw.random(), float(i)) for i in range(300)]
    found = subset.region_assign(spark.createDataFrame(grid, GRID), spark.createDataFrame(boxes, BOXES))
    assert sorted(map(tuple, found.select("region", "value").collect())) == sorted(
        (box[0], p[4]) for p in grid for box in boxes if inside(p, box)
    )


def test_bad_boxes_are_rejected_alone(spark, points, boxes):
    bad = [("x", float("inf"), 0.0, 0.0, 1.0), ("y", 1.0, None, 0.0, 1.0), ("z", 2e6, 0.0, 0.0, 1.0),
           ("n", float("nan"), 0.0, 0.0, 1.0)]
    grid, regions = spark.createDataFrame(points, GRID), spark.createDataFrame(boxes + bad, BOXES)
    rejected = subset.rejected_regions(regions).collect()
    assert {(r["region"], r["reject_reason"]) for r in rejected} == {(b[0], "bounds are not degrees") for b in bad}
    found = subset.region_assign(grid, regions)
    assert found.count() == sum(inside(point, box) for point in points for box in boxes)


def test_cells_cover_their_box(spark):
    """Dots, lines, the globe and the widest box that is let in: 16 cells at most, of fitting size."""
    boxes = [("dot", 1.0, 2.0, 1.0, 2.0), ("line", 1.0, -180.0, 1.0, 180.0), ("globe", 90.0, -180.0, -90.0, 180.0),
             ("widest", 999_999.0, -999_999.0, -999_999.0, 999_999.0), ("small", 10.01, 70.01, 10.0, 70.02)]
    cells = subset.box_cells(spark.createDataFrame(boxes, BOXES))
    found = {r["region"]: (r["n"], r["level"]) for r in cells.groupBy("region").agg(F.count("*").alias("n"), F.max("_level").alias("level")).collect()}
    assert found.keys() == {b[0] for b in boxes} and all(n <= 16 for n, _ in found.values())
    assert found["dot"] == (1, max(subset.LEVELS)) and found["small"][1] >= 15 and found["globe"][1] <= 3


def test_month_and_variable(spark, points):
    grid = spark.createDataFrame(points, GRID)
    month = subset.month_select(grid, "2024", "02")
    assert month.count() == sum(p[1].month == 2 for p in points)
    names = spark.createDataFrame([("tp",), ("tp",)], "variable string")
    wanted = sum(p[0] == "tp" for p in points)
    assert subset.variable_select(grid, names).count() == wanted
    assert subset.variable_select(grid, ["tp"]).count() == wanted


def test_filters_reach_the_scan(spark, points, tmp_path, plan):
    spark.createDataFrame(points, GRID).write.parquet(str(tmp_path / "grid"))
    grid = spark.read.parquet(str(tmp_path / "grid"))
    cut = subset.month_select(subset.box_filter(grid, [19, 74, 11, 79]), 2024, 1).select("value")
    scan = next(line for line in plan(cut).splitlines() if "FileScan" in line)
    pushed = scan.split("PushedFilters")[1]
    for part in ("GreaterThanOrEqual(lat,11.0)", "LessThanOrEqual(lon,79.0)", "GreaterThanOrEqual(valid_time"):
        assert part in pushed
    assert "variable" not in scan.split("ReadSchema")[1]


@pytest.fixture
def requested(spark, boxes):
    config = spark.createDataFrame(
        [({b[0]: list(b[1:]) for b in boxes[:4]}, {"tp": "TP", "2t": "T2"}, "2024-01-31", "2024-02-01", "nc")],
        "bounds map<string,array<double>>, variables map<string,string>, start_date string, "
        "end_date string, extension string",
    )
    return request_grid(date_ranges(config))


def expected_units(points, boxes):
    return sorted(
        (f"{box[0].upper()}_2024_{p[1].month:02}_{'TP' if p[0] == 'tp' else 'T2'}.nc", p[4])
        for p in points for box in boxes[:4] if p[1].month in (1, 2) and inside(p, box)
    )


def test_fulfil_requests(spark, points, boxes, requested, monkeypatch):
    grid = spark.createDataFrame(points, GRID)
    expected = expected_units(points, boxes)
    doubled = requested.unionByName(requested)
    found = subset.fulfil_requests(grid, doubled).select("filename", "value").collect()
    assert sorted(map(tuple, found)) == expected
    for name in ("MAX_BROADCAST_ROWS", "MAX_BROADCAST_BYTES"):
        monkeypatch.setattr(subset, name, 0)
    found = subset.fulfil_requests(grid, requested).select("filename", "value").collect()
    assert sorted(map(tuple, found)) == expected
    assert subset.fulfil_requests(grid, requested.filter("year = '1900'")).count() == 0


def far_apart(spark, path):
    """A laid out grid of 24 months and 6 names, and requests of two far months and names."""
    grid = spark.range(24 * 6 * 200).selectExpr(
        "concat('v', id % 6) AS variable",
        "timestamp_ntz '2020-01-15 00:00:00' + make_ym_interval(0, cast(id / 6 AS int) % 24) AS valid_time",
        "cast(id % 90 AS double) AS lat", "cast(id % 170 AS double) AS lon", "cast(id AS double) AS value",
    )
    write_grid(grid, path)
    laid_out = read_grid(spark, path, "valid_time timestamp_ntz, lat double, lon double, value double, variable string")
    requests = spark.createDataFrame(
        [("r", 60.0, 0.0, 10.0, 100.0, name, name, year, month, f"{name}{year}{month}") for name in ("v0", "v5") for year, month in (("2020", "01"), ("2021", "12"))],
        "region string, north double, west double, south double, east double, variable string, code string, "
        "year string, month string, filename string",
    )
    return grid, laid_out, requests


def test_requests_prune_partitions(spark, tmp_path, plan):
    """Two far months and two far names read their own partitions and none between."""
    path = str(tmp_path / "grid")
    grid, laid_out, requests = far_apart(spark, path)
    cut = subset.fulfil_requests(laid_out, requests)
    text = plan(cut).split("== Physical Plan ==")[1]
    scan = next(line for line in text.splitlines() if "FileScan" in line and "lat" in line)
    assert "dynamicpruning" in scan.split("PartitionFilters")[1]
    assert "lat" in scan.split("PushedFilters")[1] and "valid_time" in scan.split("PushedFilters")[1]
    expected = subset.fulfil_requests(grid, requests).select("filename", "value").collect()
    assert sorted(map(tuple, cut.select("filename", "value").collect())) == sorted(map(tuple, expected))
    files = cut.select(F.col("variable"), F.date_format("valid_time", "yyyyMM").alias("m")).distinct().collect()
    assert {tuple(r) for r in files} == {(v, m) for v in ("v0", "v5") for m in ("202001", "202112")}
    # Whatever lies in other partitions is never opened: they may as well be no Parquet at all.
    for folder in (tmp_path / "grid").glob("variable=*/grid_month=*"):
        if folder.parent.name not in ("variable=v0", "variable=v5") or folder.name not in ("grid_month=202001", "grid_month=202112"):
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"unreadable")
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    again = subset.fulfil_requests(laid_out, requests).select("filename", "value").collect()
    assert len(again) == len(expected) > 0


def test_requests_of_a_plain_grid_reach_the_scan(spark, points, requested, tmp_path, plan):
    path = str(tmp_path / "grid")
    spark.createDataFrame(points, GRID).write.parquet(path)
    text = plan(subset.fulfil_requests(spark.read.parquet(path), requested)).split("== Physical Plan ==")[1]
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    for name in ("valid_time", "lat", "lon"):
        assert name in scan.split("DataFilters")[1]
    assert "NestedLoop" not in text and "Cartesian" not in text


def rows_scanned(df):
    """Rows that the Parquet scan of a one-table query gave out."""
    df.toArrow()
    node = df._jdf.queryExecution().executedPlan()
    while True:
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        metrics = node.metrics()
        if "Scan" in node.nodeName():
            return metrics.apply("numOutputRows").value()
        node = node.children().apply(0)


def test_clustered_grid_prunes_within_files(spark, tmp_path):
    """A box of one percent of the area reads less than a tenth of the rows."""
    grid = spark.range(0, 400_000, 1, 4).selectExpr(
        "'t' AS variable", "timestamp_ntz '2024-01-01 00:00:00' AS valid_time",
        "(id * 7919 % 100003) / 100003 * 180 - 90 AS lat", "(id * 104729 % 99991) / 99991 * 360 - 180 AS lon",
        "cast(id AS double) AS value",
    )
    write_grid(grid, str(tmp_path / "grid"), rows_per_group=2000)
    laid_out = read_grid(spark, str(tmp_path / "grid"), "valid_time timestamp_ntz, lat double, lon double, value double, variable string")
    box = [28.0, 20.0, 10.0, 56.0]
    cut = subset.box_filter(laid_out, box)
    share = cut.count() / 400_000
    assert 0.008 < share < 0.012 and cut.count() == subset.box_filter(grid, box).count()
    assert rows_scanned(subset.box_filter(laid_out, box)) < 0.1 * 400_000


def test_morton_key_alternates_bits(spark):
    places = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (-45.0, 90.0), (12.5, 77.5), (12.5, 437.5)]
    df = spark.createDataFrame(places, "lat double, lon double").withColumn("key", morton_key())

    def plain(lat, lon):
        y = min(int((lat + 90) / 180 * 65536), 65535)
        x = min(int((lon + 180) % 360 / 360 * 65536), 65535)
        return sum((y >> i & 1) << 2 * i + 1 | (x >> i & 1) << 2 * i for i in range(16))

    assert [r["key"] for r in df.collect()] == [plain(*p) for p in places]


def test_written_units(spark, points, boxes, requested, tmp_path):
    grid, out = spark.createDataFrame(points, GRID), str(tmp_path / "units")
    for _ in range(2):
        run_requests(grid, requested, out)
    rows = spark.read.parquet(out).select("filename", "value").collect()
    assert sorted(map(tuple, rows)) == expected_units(points, boxes)
    files = {path.parent for path in (tmp_path / "units").rglob("region=*/**/*.parquet")}
    assert len(files) == len({name for name, _ in expected_units(points, boxes)})


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_is_split(spark, how):
    """Beyond a broadcast the join is a plain one, whose hot partition is split while it runs."""
    hot = F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id"))
    left = spark.range(0, 300_000, 1, 8).select(hot.alias("k"), F.repeat(F.lit("x"), 50).alias("x"))
    right = spark.range(200_000).select(F.col("id").alias("k"), F.uuid().alias("name"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = joins.lookup_join(left, right, ["k"], how, small=False)
        rows = joined.toArrow().num_rows
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "skew=true" in text
    below = 200_000 + sum(n < 200_000 for n in range(0, 300_000, 3))
    assert rows == {"inner": below, "left": 300_000, "left_semi": below, "left_anti": 300_000 - below}[how]


def test_size_check(spark):
    assert joins.fits_in_broadcast(spark.range(100), max_rows=100)
    assert not joins.fits_in_broadcast(spark.range(101), max_rows=100)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("x"))
    assert not joins.fits_in_broadcast(wide, max_bytes=9000)


def test_datasets_stay_apart(spark, points, boxes, requested, tmp_path):
    """A second dataset's run leaves the first one's units alone, and they are skipped next time."""
    grid, out = spark.createDataFrame(points, GRID), str(tmp_path / "units")
    one = requested.withColumn("ds_id", F.lit("DS1"))
    two = requested.withColumn("ds_id", F.lit("DS2"))
    run_requests(grid, one, out)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "units").rglob("*.parquet")}
    run_requests(grid, two, out)
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    rows = spark.read.parquet(out).select("ds_id", "filename", "value").collect()
    units = expected_units(points, boxes)
    assert sorted(map(tuple, rows)) == sorted((d, *u) for d in ("DS1", "DS2") for u in units)
    inventory = spark.createDataFrame([(str(p),) for p in (tmp_path / "units").rglob("*.parquet")], "path string")
    units = delivered_units(inventory)
    left = skip_existing(two.unionByName(one), units, on=tuple(units.columns))
    there = {(d, name) for d in ("DS1", "DS2") for name, _ in expected_units(points, boxes)}
    wanted = {(r["ds_id"], r["filename"]) for r in two.unionByName(one).collect()}
    assert {(r["ds_id"], r["filename"]) for r in left.collect()} == wanted - there


CONFIG = (
    "ds_id string, ds_name string, ds_source string, folder_name string, bounds map<string,array<double>>, "
    "variables map<string,string>, start_date string, end_date string, extension string"
)


def config(spark, folder="f1", box=(19.0, 74.0, 11.0, 79.0), region="ka", variables=("tp", "2t"), end="2024-02-01"):
    names = {name: name.upper() for name in variables}
    return spark.createDataFrame(
        [("DS1", "Single_Level", "store", folder, {region: list(box)}, names, "2024-01-01", end, "nc")], CONFIG
    )


def held(spark, out, grid):
    schema = (
        "variable string, valid_time timestamp_ntz, lat double, lon double, value double, filename string, ds_id string, "
        "ds_name string, folder_name string, region string, year string, month string, code string, extension string"
    )
    rows = read_units(spark, out, schema).collect()
    return sorted((r["folder_name"], r["filename"], r["value"]) for r in rows)


def expected_rows(points, folder, box, region="ka"):
    return sorted(
        (folder, f"{region.upper()}_2024_{p[1].month:02}_{p[0].upper()}.nc", p[4])
        for p in points if p[1].month in (1, 2) and inside(p, (region, *box))
    )


NORTH, SOUTH = (19.0, 74.0, 11.0, 79.0), (14.0, 76.0, 8.0, 81.0)


def test_folders_of_a_dataset_stay_apart(spark, points, tmp_path):
    """Two folders of one dataset hold other boxes of a region; neither run touches the other's."""
    grid, out = spark.createDataFrame(points, GRID), str(tmp_path / "units")
    for folder, box in (("f1", NORTH), ("f2", SOUTH)):
        requests = plan_requests(config(spark, folder, box), delivery_record(spark, out), overwrite=False)
        assert requests.count() == 4
        run_requests(grid, requests, out, "2024-03-01 00:00:00")
    assert held(spark, out, grid) == expected_rows(points, "f1", NORTH) + expected_rows(points, "f2", SOUTH)


@pytest.mark.parametrize("region", ["a:b", "a%b", "a=b", "a b+c", "{x}/[y]"])
def test_delivered_units_are_not_planned_again(spark, points, tmp_path, region):
    grid, out = spark.createDataFrame(points, GRID), str(tmp_path / "units")
    configs = config(spark, region=region)
    run_requests(grid, plan_requests(configs), out, "2024-03-01 00:00:00")
    assert plan_requests(configs, delivery_record(spark, out), overwrite=False).count() == 0
    assert held(spark, out, grid) == expected_rows(points, "f1", NORTH, region)
    flagged = plan_requests(configs, delivery_record(spark, out), overwrite=True)
    assert [r["replaces"] for r in flagged.collect()] == [True] * 4
    inventory = spark.createDataFrame([(str(p),) for p in (tmp_path / "units").rglob("*.parquet")], "path string")
    assert {r["region"] for r in delivered_units(inventory).collect()} == {region}


def test_emptied_units_lose_their_rows(spark, points, tmp_path):
    """A unit whose new box holds no points is emptied; its neighbours keep their files."""
    grid, out = spark.createDataFrame(points, GRID), str(tmp_path / "units")
    run_requests(grid, plan_requests(config(spark)), out, "2024-03-01 00:00:00")
    run_requests(grid, plan_requests(config(spark, "f2")), out, "2024-03-01 00:00:00")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "units").rglob("*.parquet") if "f2" in str(p)}
    nowhere = config(spark, box=(89.99, 0.0, 89.98, 0.001), variables=("tp",))
    run_requests(grid, plan_requests(nowhere), out, "2024-03-02 00:00:00")
    rows = expected_rows(points, "f1", NORTH) + expected_rows(points, "f2", NORTH)
    assert held(spark, out, grid) == sorted(r for r in rows if r[0] == "f2" or not r[1].endswith("TP.nc"))
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    record = {(r["folder_name"], r["filename"]): r["n_rows"] for r in delivery_record(spark, out).collect()}
    assert record["f1", "KA_2024_01_TP.nc"] == 0 < record["f2", "KA_2024_01_TP.nc"]
    assert record["f1", "KA_2024_01_2T.nc"] == sum(r[:2] == ("f1", "KA_2024_01_2T.nc") for r in rows)


def test_units_without_points_are_not_planned_again(spark, points, tmp_path):
    grid, out = spark.createDataFrame(points, GRID), str(tmp_path / "units")
    configs = config(spark, box=(89.99, 0.0, 89.98, 0.001))
    run_requests(grid, plan_requests(configs), out, "2024-03-01 00:00:00")
    record = delivery_record(spark, out)
    assert [r["n_rows"] for r in record.collect()] == [0] * 4
    assert plan_requests(configs, record, overwrite=False).count() == 0
    later = plan_requests(config(spark, box=(89.99, 0.0, 89.98, 0.001), end="2024-03-31"), record, overwrite=False)
    assert {r["month"] for r in later.collect()} == {"03"}


def test_report_from_the_record(spark, points, tmp_path):
    """The ledger and the report of a run come from what the sink recorded."""
    grid, out = spark.createDataFrame(points, GRID), str(tmp_path / "units")
    requests = plan_requests(config(spark))
    run_requests(grid, requests.filter("code = 'TP'"), out, "2024-03-01 00:00:00")
    latest = spark.createDataFrame([("DS1", at("2024-02-28"))], "ds_id string, latest timestamp_ntz")
    ledger = recorded_ledger(requests, delivery_record(spark, out))
    assert {r["key"][-10:]: r["ok"] for r in ledger.collect()} == {
        "4_01_TP.nc": True, "4_02_TP.nc": True, "4_01_2T.nc": False, "4_02_2T.nc": False,
    }
    assert report_run(requests, ledger, latest, "2024-03-01 00:00:00").first()["status"] == "CRITICAL"
    run_requests(grid, requests, out, "2024-03-01 01:00:00")
    ledger = recorded_ledger(requests, delivery_record(spark, out))
    report = report_run(requests, ledger, latest, "2024-03-01 00:00:00").first()
    assert (report["status"], report["n_files"]) == ("SUCCESS", 4)
