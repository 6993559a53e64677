"""Request planning, availability and forecast files, on stated cases."""

from datetime import date, datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from barograph.operators import accounting, availability, requests
from barograph.operators.numbering import number_rows
from barograph.operators.report import entries_in_order
from barograph.plans import (
    forecast_verdict,
    month_to_date_requests,
    plan_forecast,
    plan_requests,
    published_runs,
)
from barograph.sinks import write_ledger
from barograph.sources import listing_links

VARIABLES = {"soil_wetness": "2t", "snow_depth": "sd", "sea_state": "ss", "cloud_base": "cb", "dust": "du"}


@pytest.fixture
def configs(spark):
    def make(*ranges):
        rows = [
            ("DS0046", "Single_Level", "all_files", "store", "nc",
             start, end, {"ka": [18.5, 73.5, 11.5, 78.5]}, VARIABLES)
            for start, end in ranges
        ]
        return spark.createDataFrame(
            rows,
            "ds_id string, ds_name string, folder_name string, ds_source string, extension string, "
            "start_date string, end_date string, bounds map<string,array<double>>, "
            "variables map<string,string>",
        )

    return make


def test_grid(configs):
    planned = plan_requests(configs(("2023-11-20", "2024-02-10")))
    rows = planned.orderBy("year", "month", "code").collect()
    assert len(rows) == 20
    assert sorted({(r["year"], r["month"]) for r in rows}) == [
        ("2023", "11"), ("2023", "12"), ("2024", "01"), ("2024", "02"),
    ]
    first = next(r for r in rows if r["code"] == "2t")
    assert first["filename"] == "KA_2023_11_2t.nc"
    assert first["object_key"] == (
        "DS0046-Single_Level/all_files/KA/KA_2023_11_2t.nc"
    )
    assert [first[n] for n in ("north", "west", "south", "east")] == [18.5, 73.5, 11.5, 78.5]


def test_grid_spread_over_tasks(configs):
    config = requests.date_ranges(configs(("2023-11-20", "2024-02-10")))
    spread = requests.request_grid(config, tasks=4)
    assert spread.exceptAll(requests.request_grid(config)).count() == 0
    assert spread.count() == 20


def test_one_large_configuration_is_spread_evenly(spark):
    """Two million requests of one configuration: every task of a shuffle unfolds its share."""
    config = spark.range(1).select(
        F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.struct(
            F.concat(F.lit("r"), i.cast("string")), F.array(*[F.lit(float(n)) for n in (4, 1, 2, 3)])))).alias("bounds"),
        F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(21)), lambda i: F.struct(
            F.concat(F.lit("v"), i.cast("string")), F.concat(F.lit("c"), i.cast("string"))))).alias("variables"),
        F.lit("2000-05-31").cast("date").alias("start_date"), F.lit("2019-04-01").cast("date").alias("end_date"),
        F.lit("nc").alias("extension"),
    )
    grid = requests.request_grid(config)
    total = 400 * 21 * (12 * 19)
    tasks = [r["count"] for r in grid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == total and len(tasks) == 8 and max(tasks) < 1.1 * total / 8
    assert grid.select("region", "year", "month", "variable").distinct().count() == total
    edges = grid.agg(F.min(F.concat("year", "month")), F.max(F.concat("year", "month"))).first()
    assert tuple(edges) == ("200005", "201904")
    wrong = grid.filter("substr(variable, 2) <> substr(code, 2) OR north <> 4 OR east <> 3 OR west <> 1 OR south <> 2")
    assert wrong.count() == 0


def test_configurations_without_requests(spark):
    """Empty or missing maps and ranges give no requests and leave others alone."""
    rows = [
        ("none", {}, {"v": "c"}, date(2024, 1, 1), date(2024, 1, 2)), ("no codes", {"r": [1.0, 1.0, 1.0, 1.0]}, {}, date(2024, 1, 1), date(2024, 1, 2)),
        ("null", None, {"v": "c"}, date(2024, 1, 1), date(2024, 1, 2)), ("open", {"r": [1.0, 1.0, 1.0, 1.0]}, {"v": "c"}, None, date(2024, 1, 2)),
        ("one", {"r": [1.0, 1.0, 1.0, 1.0]}, {"v": "c"}, date(2024, 1, 31), date(2024, 1, 31)),
    ]
    schema = "ds_id string, bounds map<string,array<double>>, variables map<string,string>, start_date date, end_date date"
    grid = requests.request_grid(spark.createDataFrame(rows, schema).withColumn("extension", F.lit("nc")))
    assert [(r["ds_id"], r["filename"]) for r in grid.collect()] == [("one", "R_2024_01_c.nc")]


@pytest.mark.parametrize(
    "start, end",
    [("2024-01-20", "2024-01-10"), ("2024-03-01", "2024-01-10"), ("None", "None"), ("2024-01-01", None)],
)
def test_no_requests(configs, start, end):
    assert plan_requests(configs((start, end))).count() == 0


def test_bad_range_leaves_others_alone(configs):
    planned = plan_requests(configs(("None", "None"), ("2024-01-31", "2024-02-01")))
    assert planned.count() == 10


def test_skip_existing(spark, configs):
    config = configs(("2023-11-20", "2024-02-10"))
    key = plan_requests(config).filter("filename = 'KA_2023_11_2t.nc'").select("object_key")
    twice = key.unionByName(key)
    assert plan_requests(config, twice, overwrite=False).count() == 19
    kept = plan_requests(config, twice, overwrite=True)
    assert kept.count() == 20
    assert [r["filename"] for r in kept.filter("replaces").collect()] == ["KA_2023_11_2t.nc"]


def test_month_to_date(spark):
    latest = spark.sql("SELECT timestamp_ntz'2024-02-10 05:00:00' AS latest")
    row = requests.month_to_date(latest).first()
    assert (row["start_date"], row["end_date"]) == (date(2024, 2, 1), date(2024, 2, 10))


def test_variable_code(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("z",)], "variable string")
    codes = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "2")], "variable string, code string")
    found = {r["variable"]: r["code"] for r in requests.variable_code(rows, codes).collect()}
    assert found == {"a": "1", "b": "2", "z": None}
    with pytest.raises(PySparkException, match="no code for variable z"):
        requests.variable_code(rows, codes, strict=True).collect()
    assert requests.variable_code(rows, None).filter("code = variable").count() == 3


@pytest.mark.parametrize(
    "message, latest",
    [
        ("400 Client Error: Bad Request. The latest date available is: 2024-01-01 05:00", "2024-01-01 05:00:00"),
        ("400 x. up to 2024-01-01 05:37", "2024-01-01 05:37:00"),
        ("400 no date", None),
        ("400 up to 2024-01-01 05:00. Sorry", None),
        ("400 up to 2024-13-01 05:00", None),
        (None, None),
    ],
)
def test_latest_from_message(spark, message, latest):
    found = requests.latest_from_message(spark.createDataFrame([(message,)], "msg string")).first()
    assert (str(found["latest"]) if found["latest"] else None) == latest


def test_latest_only_from_bad_requests(spark):
    rows = spark.createDataFrame([("401 x. 2024-01-01 05:00",), ("400 x. 2024-01-01 05:00",)], "msg string")
    latest = requests.latest_from_message(rows, only_status="400").collect()
    assert [r["latest"] is None for r in latest] == [True, False]


def test_listing_links(spark):
    html = (
        "<A HREF='/f/20240101/'>a</A><a class=\"x\" href=\"/f/20240102/\">b</a><a href=/f/20240103/>c</a>"
        "<a href=\"\">e</a><a>n</a><a data-href=\"/no/\" href=\"/f/readme\">r</a><abbr href=\"/no/\">q</abbr>"
        "<!-- <a href=\"/no/\">z</a> --><script>'<a href=\"/no/\">'</script><a\nhref=\"/q?a=1&amp;b=2/\">m</a>"
    )
    pages = spark.createDataFrame([("s", html), ("t", None)], "source string, html string")
    found = [r["href"] for r in listing_links(pages).collect()]
    assert found == ["/f/20240101/", "/f/20240102/", "/f/20240103/", "/q?a=1&b=2/"]
    assert "/f/readme" in [r["href"] for r in listing_links(pages, directories_only=False).collect()]


def test_listing_dates_skips(spark):
    hrefs = ["../", "/", "/forecasts/readme/", "/forecasts/20241301/", "/forecasts/20240102/", "x/20240102/"]
    links = spark.createDataFrame([(h,) for h in hrefs], "href string")
    assert [r["href"] for r in availability.listing_dates(links).collect()] == ["/forecasts/20240102/"]


@pytest.mark.parametrize(
    "days, now, latest",
    [
        (["20240101", "20240102"], "2024-01-02 08:49:00", "2024-01-01"),
        (["20240101", "20240102"], "2024-01-02 08:49:01", "2024-01-02"),
        (["20240101", "20240102"], datetime(2024, 1, 2, 8, 49, 1), "2024-01-02"),
        (["20240101", "20240102"], datetime(2024, 1, 2, 8, 49, tzinfo=timezone.utc), "2024-01-01"),
        (["20231231", "20240102"], "2024-01-02 08:00:00", None),
        (["20231231", "20240102"], "2024-01-02 09:00:00", "2024-01-02"),
        (["20240102", "20240102", "20240101"], "2024-01-01 00:00:00", "2024-01-01"),
    ],
)
def test_latest_published(spark, days, now, latest):
    html = "".join(f'<a href="/forecasts/{day}/">x</a>' for day in days)
    listings = spark.createDataFrame([("s", html)], "source string, html string")
    found = published_runs(listings, now).collect()
    assert [(str(r["latest"]) if r["latest"] else None) for r in found] == [latest]


def test_forecast_files(spark):
    runs = spark.createDataFrame(
        [("https://data.example/forecasts", date(2024, 1, 2)), ("https://other", None)],
        "source string, latest date",
    )
    files = plan_forecast(runs).orderBy("slot").collect()
    assert [f["lead"] for f in files] == ["0h", "6h"]
    url = "https://data.example/forecasts/20240102/00z/ifs/0p25/oper/20240102000000-0h-oper-fc"
    assert (files[0]["url"], files[0]["index_url"]) == (url + ".grib2", url + ".index")
    assert [f["lead"] for f in plan_forecast(runs, leads="12h").collect()] == ["12h"]
    with pytest.raises(PySparkException, match="unsupported"):
        plan_forecast(runs, model="aifs").collect()
    assert plan_forecast(runs, model="aifs", strict=False).count() == 0


@pytest.mark.parametrize(
    "missing, n_data, n_index, ok",
    [((), 2, 2, True), (("6h-fc.index",), 2, 1, False), (("6h-fc.grib2",), 1, 1, False)],
)
def test_pair_completeness(spark, missing, n_data, n_index, ok):
    names = [f"{lead}-fc.{ext}" for lead in ("0h", "6h") for ext in ("grib2", "index")]
    expected = spark.createDataFrame(
        [("r", n) for n in names if n.endswith("grib2")], "run string, filename string"
    )
    arrived = spark.createDataFrame([(n,) for n in names if n not in missing] * 2, "filename string")
    row = accounting.pair_completeness(expected, arrived).first()
    assert (row["n_data"], row["n_index"], row["ok"]) == (n_data, n_index, ok)
    strict = accounting.pair_completeness(expected, arrived, strict=True)
    if ok:
        assert strict.first()["ok"]
    else:
        with pytest.raises(PySparkException, match="files missing for run r"):
            strict.collect()


def test_anti_join_plan(configs, plan):
    config = configs(("2023-11-20", "2024-02-10"))
    text = plan(plan_requests(config, plan_requests(config).select("object_key"), overwrite=False))
    assert "LeftAnti" in text and "BroadcastHashJoin" in text and "NestedLoop" not in text




def test_request_days(spark):
    days = requests.request_days(spark.range(1)).first()["days"]
    assert days == [f"{i:02}" for i in range(1, 32)]


def test_expand_months_from_timestamps(spark):
    rows = spark.range(1).select(
        F.lit("2023-12-31 23:00:00").cast("timestamp_ntz").alias("start_date"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("end_date"),
    )
    found = [(r["year"], r["month"]) for r in requests.expand_months(rows).collect()]
    assert found == [("2023", "12"), ("2024", "01")]


def test_ambiguous_codes(spark):
    """Two codes of one name: strict fails and names it, otherwise the name itself serves."""
    codes = spark.createDataFrame(
        [("t", "a"), ("t", "b"), ("u", "c"), ("u", "c"), ("w", None)], "variable string, code string"
    )
    rows = spark.createDataFrame([("t",), ("u",), ("w",), ("x",)], "variable string")
    found = {r["variable"]: r["code"] for r in requests.variable_code(rows, codes).collect()}
    assert found == {"t": "t", "u": "c", "w": None, "x": None}
    assert [(r["variable"], r["codes"]) for r in requests.ambiguous_codes(codes).collect()] == [("t", ["a", "b"])]
    for name, message in (("t", "several codes for variable t"), ("x", "no code for variable x")):
        with pytest.raises(PySparkException, match=message):
            requests.variable_code(rows.filter(f"variable = '{name}'"), codes, strict=True).collect()
    assert requests.variable_code(rows.filter("variable = 'u'"), codes, strict=True).first()["code"] == "c"


def test_month_to_date_run(spark, configs):
    """The newest timestamp a message names sets the range; without one there are no requests."""
    config = configs(("None", "None"))
    messages = spark.createDataFrame(
        [("DS0046", "400 Client Error. Data up to: 2024-02-10 07:00"), ("DS0046", "400 Client Error. Data up to: 2024-03-02 05:00"),
         ("DS0047", "400 Client Error. Data up to: 2024-05-02 05:00")], "ds_id string, msg string"
    )
    planned = month_to_date_requests(config, messages)
    assert {(r["year"], r["month"]) for r in planned.collect()} == {("2024", "03")} and planned.count() == 5
    silent = messages.withColumn("msg", F.lit("400 Client Error. Nothing"))
    assert month_to_date_requests(config, silent).count() == 0


def test_forecast_verdict(spark):
    """A run is complete once every planned file and its index are there, source by source."""
    runs = spark.createDataFrame(
        [("https://a", date(2024, 1, 2)), ("https://b", date(2024, 1, 2)), ("https://c", None)], "source string, latest date"
    )
    files = plan_forecast(runs)
    everything = files.select("base", F.explode(F.array("filename", "index_filename")).alias("filename"))
    arrived = everything.filter("base = 'https://a' OR filename NOT LIKE '%6h%index'")
    verdict = {r["base"]: (r["n_leads"], r["n_data"], r["n_index"], r["ok"]) for r in forecast_verdict(files, arrived).collect()}
    assert verdict == {"https://a": (2, 2, 2, True), "https://b": (2, 2, 1, False)}
    with pytest.raises(PySparkException, match="files missing for run"):
        forecast_verdict(files, arrived, strict=True).collect()


def test_bucketed_ledger_is_not_shuffled(spark, configs, plan):
    """A day's requests go to the ledger's buckets; the ledger stays where it lies."""
    config = configs(("2023-11-20", "2024-02-10"))
    planned = plan_requests(config)
    spark.sql("DROP TABLE IF EXISTS delivered_test")
    write_ledger(planned.filter("month <> '02'").select("object_key"), "delivered_test", buckets=8)
    write_ledger(planned.filter("month = '12'").select("object_key"), "delivered_test", buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rest = requests.skip_existing(planned, spark.table("delivered_test"), on=("object_key",), small=False)
        text = plan(rest).split("== Physical Plan ==")[1]
        assert {r["month"] for r in rest.collect()} == {"02"} and rest.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The join has two branches: the requests are shuffled to the buckets, the ledger is read as it lies.
    top = text.index("SortMergeJoin")
    ledger = text.rindex("\n      +- Sort", top)
    assert "Exchange hashpartitioning(object_key" in text[top:ledger]
    assert "Exchange" not in text[ledger:] and "Bucketed: true" in text[ledger:]
    spark.sql("DROP TABLE delivered_test")


@pytest.mark.parametrize("tasks", [1, 7])
def test_numbering_equals_row_number(spark, plan, tasks):
    rows = spark.range(0, 5000, 1, tasks).select(F.xxhash64("id").alias("h"), (F.col("id") % 7).alias("g"), "id")
    found = number_rows(rows, "g", "h")
    expected = rows.select("id", F.row_number().over(Window.orderBy("g", "h")).cast("bigint").alias("seq"))
    assert found.select("id", "seq").exceptAll(expected).count() == 0 and found.count() == 5000
    text = plan(found)
    # Only the counts, a row per task, come together; the rows are read and joined as they lie.
    assert "Window" not in text and "SinglePartition" not in text.split("== Physical Plan ==")[1].split("BroadcastExchange")[0]
    assert number_rows(rows.limit(0), "g").count() == 0


def test_entries_of_several_tables_keep_their_order(spark):
    schema = "job string, component string, at int"
    first = spark.createDataFrame([("j", f"a{i}", i) for i in range(50)], schema)
    second = spark.createDataFrame([("j", f"b{i}", -i) for i in range(50)], schema)
    rows = entries_in_order([first, second], "at").orderBy("seq").collect()
    assert [r["component"] for r in rows] == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(49, -1, -1)]
    assert [r["seq"] for r in rows] == list(range(1, 101))
