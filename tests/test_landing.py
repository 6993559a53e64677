"""Landed responses, in batch and as a stream, and the CSV files they become."""

import csv
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from barograph import schemas as S
from barograph.plans import clean_snapshots
from barograph.session import fewer_reading_tasks, scratch_dir
from barograph.sinks import mounted, partitioned, read_snapshots, write_snapshots
from barograph.sources import (
    counting_files,
    dataset_filter,
    landed_payloads,
    latest_payloads,
    parse_payloads,
    payload_columns,
    payload_rejects,
    read_payloads,
)
from barograph.sources import folders
from barograph.sources.observations import readable_records
from barograph.streaming import stream_snapshots
from checks import files

RECORD = {"Station": " Mysuru ", "Station Id": "043296", "Date of Observation": "2024-01-02", "Time": 3}
AWS_RECORD = {"ID": "A1", "DATE": "2024-01-02", "TIME": "06:30:00", "RAIN": 1.5}
COLUMNS = [*S.STATION_RAW, "Extra"]


class Landing:
    def __init__(self, folder):
        self.folder = folder

    def add(self, timecode, body, code=S.STATION_DATASET, name="a", age=0):
        folder = self.folder / f"datacode={code}" / f"timecode={timecode}"
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"{name}.json"
        path.write_text(body if isinstance(body, str) else json.dumps(body, indent=1))
        moment = time.time() - age
        os.utime(path, (moment, moment))
        return path


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path / "landing")


def rows_of(path):
    """Rows of all CSV files below a folder, by partition, read without Spark."""
    found = {}
    for file in sorted(path.rglob("*.csv")):
        partition = str(file.parent.relative_to(path))
        with open(file, newline="") as lines:
            found.setdefault(partition, []).extend(csv.DictReader(lines))
    return found


def partition(time_label, code=S.STATION_DATASET):
    return f"dataset={code}/snap_date=2024_01_02/snap_time={time_label}"


def test_values_are_text(spark, landing):
    landing.add("t1", [RECORD, {**RECORD, "Time": "03", "Temperature": 25.3, "Extra": "e"}, {"Time": None}])
    rows = parse_payloads(landed_payloads(spark, str(landing.folder)), COLUMNS).collect()
    assert [(r["Station Id"], r["Time"], r["Temperature"], r["Extra"]) for r in rows] == [
        ("043296", "3", None, None), ("043296", "03", "25.3", "e"), (None, None, None, None),
    ]


def test_responses_without_records(spark, landing):
    bodies = {
        "t1": [RECORD], "t2": "<html>[oops]</html>", "t3": RECORD, "t4": [], "t5": "[{\"Time\": 3},",
        "t7": "[1, 2]", "t8": "  [ {\"Time\": 3} ]\n", "t9": "[{\"Time\": 3}] trailing",
    }
    for timecode, body in bodies.items():
        landing.add(timecode, body)
    payloads = landed_payloads(spark, str(landing.folder))
    parsed = [r["timecode"] for r in parse_payloads(payloads, COLUMNS).collect()]
    assert sorted(parsed) == ["t1", "t8"]
    rejected = sorted(r["timecode"] for r in payload_rejects(payloads).collect())
    assert rejected == ["t2", "t3", "t5", "t7", "t9"]


def test_unknown_columns_are_found(spark, landing):
    landing.add("t1", [RECORD, {"New One": 1}])
    found = {r["column"] for r in payload_columns(landed_payloads(spark, str(landing.folder))).collect()}
    assert found == {*RECORD, "New One"}


def test_last_file_counts(spark, landing, tmp_path, plan):
    landing.add("t1", [RECORD], name="z", age=50)
    landing.add("t1", [{**RECORD, "Time": 9}], name="a", age=10)
    landing.add("t2", [RECORD], name="z", age=90)
    payloads = landed_payloads(spark, str(landing.folder))
    kept = latest_payloads(payloads)
    assert {(r["timecode"], r["landed_file"][-6:]) for r in kept.collect()} == {("t1", "a.json"), ("t2", "z.json")}
    again = latest_payloads(kept).collect()
    assert len(again) == 2 and kept.columns == payloads.columns
    # Stored responses are judged by their flags: no text is read to find the files that count.
    read_payloads(payloads).write.parquet(str(tmp_path / "read"))
    read = spark.read.parquet(str(tmp_path / "read"))
    scan = plan(counting_files(read)).split("ReadSchema")[1].splitlines()[0]
    assert "readable" in scan and "records" not in scan and "payload" not in scan
    assert {r["landed_file"][-6:] for r in latest_payloads(read).collect()} == {"a.json", "z.json"}


def test_only_the_dataset_is_listed(spark, landing, plan):
    landing.add("t1", [RECORD])
    landing.add("t1", [AWS_RECORD], code=S.AWS_DATASET)
    landing.add("t1", "{}", code="cds")
    payloads = dataset_filter(landed_payloads(spark, str(landing.folder)), "datacode")
    assert "StartsWith" in plan(payloads).split("PartitionFilters")[1].split("]")[0]
    assert {r["datacode"] for r in payloads.collect()} == {S.STATION_DATASET, S.AWS_DATASET}


def test_batch_run(spark, landing, tmp_path):
    landing.add("2024-01-02T03-00-00", [RECORD, {**RECORD, "Station": "x,\"y\"\nz", "Temperature": "NA"}])
    landing.add("2024-01-02T04-00-00", [{**RECORD, "Time": 4, "Temperature": 7}])
    landing.add("2024-01-02T03-00-00", [AWS_RECORD], code=S.AWS_DATASET)
    out = tmp_path / "out"
    clean_snapshots(spark, str(landing.folder), str(out), S.STATION_DATASET)
    columns = [*S.AWS_RAW, "RAIN"]
    clean_snapshots(spark, str(landing.folder), str(out), S.AWS_DATASET, columns)
    found = rows_of(out)
    assert set(found) == {
        partition("03_00_00"), partition("04_00_00"), partition("03_00_00", S.AWS_DATASET),
    }
    first, second = found[partition("03_00_00")]
    assert list(first) == S.STATION_CLEAN_SCHEMA.names
    assert (first["timestamp"], first["stationID"]) == ("2024-01-02T03:00:00.00+05:30", "043296")
    assert (second["stationName"], second["temperature"]) == ("X,\"Y\"\nZ", "")
    assert found[partition("04_00_00")][0]["temperature"] == "7.0"
    assert found[partition("03_00_00", S.AWS_DATASET)] == [
        {"timestamp": "2024-01-02T06:30:00.00+05:30", "stationID": "A1", "RAIN": "1.5"}
    ]
    assert all(len(list((out / name).glob("*.csv"))) == 1 for name in found)


def test_stream(spark, landing, tmp_path):
    out, rejects = tmp_path / "out", tmp_path / "rejects"

    def run():
        query = stream_snapshots(
            spark, str(landing.folder), str(out), str(tmp_path / "progress"), S.STATION_DATASET,
            rejects=str(rejects),
        )
        query.awaitTermination()
        return rows_of(out)

    landing.add("2024-01-02T03-00-00", [RECORD], name="new", age=10)
    landing.add("2024-01-02T03-00-00", [RECORD, RECORD], name="old", age=60)
    landing.add("2024-01-02T04-00-00", "<html>busy</html>")
    landing.add("2024-01-02T03-00-00", [AWS_RECORD], code=S.AWS_DATASET)
    first = run()
    assert {name: len(rows) for name, rows in first.items()} == {partition("03_00_00"): 1}
    assert run() == first
    landing.add("2024-01-02T05-00-00", [RECORD, RECORD])
    third = run()
    assert {name: len(rows) for name, rows in third.items()} == {
        partition("03_00_00"): 1, partition("05_00_00"): 2,
    }
    # A response that lands again replaces its snapshot.
    landing.add("2024-01-02T05-00-00", [RECORD], name="again")
    assert len(run()[partition("05_00_00")]) == 1
    rejected = spark.read.json(str(rejects / "batch=0"))
    assert [r["timecode"] for r in rejected.collect()] == ["2024-01-02T04-00-00"]


def test_batch_and_stream_agree(spark, landing, tmp_path):
    for hour in range(5):
        landing.add(f"2024-01-02T0{hour}-00-00", [{**RECORD, "Time": hour}] * (hour + 1))
    clean_snapshots(spark, str(landing.folder), str(tmp_path / "batch"), S.STATION_DATASET)
    stream_snapshots(
        spark, str(landing.folder), str(tmp_path / "stream"), str(tmp_path / "progress"), S.STATION_DATASET,
        files_per_batch=2,
    ).awaitTermination()
    assert rows_of(tmp_path / "batch") == rows_of(tmp_path / "stream")


NOTES = ["x,y", 'q"z', '"', "", None, "  padded ", "two\nlines", "cr\rlf\r\n", "back\\slash", "NA", "'"]


def test_csv_values(spark, tmp_path):
    rows = [(i, note, "d", "2024_01_02", "03_00_00") for i, note in enumerate(NOTES)]
    df = spark.createDataFrame(rows, "i int, note string, dataset string, snap_date string, snap_time string")
    for _ in range(2):
        write_snapshots(df, str(tmp_path))
    plain = rows_of(tmp_path)[partition("03_00_00", "d")]
    assert {int(r["i"]): r["note"] for r in plain} == {i: note or "" for i, note in enumerate(NOTES)}
    back = read_snapshots(spark, str(tmp_path), df.schema).collect()
    assert {r["i"]: r["note"] for r in back} == {i: note or None for i, note in enumerate(NOTES)}


def test_replaces_only_its_partitions(spark, tmp_path):
    def write(time_label, n):
        rows = spark.range(n).selectExpr(
            "id", "'d' AS dataset", "'2024_01_02' AS snap_date", f"'{time_label}' AS snap_time"
        )
        write_snapshots(rows, str(tmp_path))

    write("03_00_00", 5)
    write("04_00_00", 3)
    write("03_00_00", 2)
    found = {name: len(rows) for name, rows in rows_of(tmp_path).items()}
    assert found == {partition("03_00_00", "d"): 2, partition("04_00_00", "d"): 3}


def test_hot_snapshot_is_split(spark, tmp_path):
    rows = spark.range(0, 300_000, 1, 8).selectExpr(
        "repeat(cast(id AS string), 20) AS t", "'d' AS dataset", "'2024_01_02' AS snap_date",
        "CASE WHEN id % 3 = 0 THEN '03_00_00' ELSE concat(id % 7, '') END AS snap_time",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        write_snapshots(rows, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / partition("03_00_00", "d")).glob("*.csv"))) > 2


class Session:
    """A session whose settings are given as a dict, which is what ``conf.get`` asks."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_scratch_folder():
    shared = Session(spark_checkpoint_dir="s3a://bucket/tmp/", spark_master="spark://host")
    assert scratch_dir(shared, "x").startswith("s3a://bucket/tmp/x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")
    for master in ("local[2]", "spark://host"):
        unset = Session(spark_sql_warehouse_dir="s3a://bucket/warehouse/", spark_master=master)
        assert scratch_dir(unset, "x").startswith("s3a://bucket/warehouse/barograph-scratch/x-")


def test_rows_or_rejects(spark, landing):
    """Every response either gives rows or is rejected; what follows an array rejects it."""
    bodies = {
        "t1": "[{\"Time\": 3}][{\"Time\": 4}]", "t2": "[{\"Time\": 3}] x ]", "t3": "[{\"Time\": 3}, null]",
        "t4": "[{\"Time\": 3}, {\"Time\": 4}]", "t5": "[{\"Time\": 3}],[{\"Time\": 4}]",
    }
    for timecode, body in bodies.items():
        landing.add(timecode, body)
    payloads = landed_payloads(spark, str(landing.folder))
    rows = [(r["timecode"], r["Time"]) for r in parse_payloads(payloads, COLUMNS).collect()]
    assert sorted(rows) == [("t4", "3"), ("t4", "4")]
    assert sorted(r["timecode"] for r in payload_rejects(payloads).collect()) == ["t1", "t2", "t3", "t5"]


def test_late_error_page_replaces_nothing(spark, landing):
    landing.add("t1", [RECORD], name="a", age=50)
    landing.add("t1", "<html>503</html>", name="b", age=10)
    landing.add("t2", "<html>1</html>", name="a", age=50)
    landing.add("t2", "<html>2</html>", name="b", age=10)
    kept = latest_payloads(landed_payloads(spark, str(landing.folder))).collect()
    assert sorted((r["timecode"], r["landed_file"][-6:]) for r in kept) == [("t1", "a.json"), ("t2", "b.json")]


# Texts that are no array of records, though they begin with one or nearly are one.
SPOILT = [
    '[{"Time":3}]]', '[{"Time":3}]] <html>503</html> ]', '[{"Time":3}]],[[{"Time":4}]', "[{'Time':3}]", '[{"Time":NaN}]',
    '[{"Time":3}][]', '[{"Time":3}] []', '[{"Time":3}]{}]', '[{"Time":3}]"]"]', '[{"a":[1]}]]', '[{"a":{"b":[1]}}],[{"a":1}]',
    '[{"Time":3},]', '[{"Time":03}]', '[{"Time":3}', '{"Time":3}', '[1]', '[[{"Time":3}]]', '[null]', '"[]"', '[{"a":"x\ny"}]',
    '[{"Time":3}],', ']', '[', '[]]', '[][]',
]
EXACT = {
    '[{"Time":3}]': ["3"], ' [ {"Time":3} ,\n{"Time":"4"}]\r\n\t': ["3", "4"], '[{"Time":"]}"}]': ["]}"], '[{"Time":"a\\"]b"}]': ['a"]b'],
    '[{"Time":"\\\\"}]': ["\\"], '[{"Time":{"b":[1,[2]]}},{"Time":[]}]': ['{"b":[1,[2]]}', "[]"], "[]": [], '[{"Time":1e400}]': ["Infinity"],
    '[{"Time":"\\u005d"}]': ["]"], '[{"Time":null}]': [None], '[{"x":1,"x":2}]': [None], '[{"Time":"' + '\\"]' * 9000 + '"}]': ['"]' * 9000],
}


def test_only_whole_documents_are_read(spark):
    """Rows and rejects share every response between them."""
    texts = [*SPOILT, *EXACT]
    payloads = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    rows = {}
    for r in parse_payloads(payloads, ["Time"]).orderBy("n").collect():
        rows.setdefault(texts[r["n"]], []).append(r["Time"])
    assert rows == {text: values for text, values in EXACT.items() if values}
    assert {texts[r["n"]] for r in payload_rejects(payloads).collect()} == set(SPOILT)
    read = read_payloads(payloads)
    assert {texts[r["n"]] for r in payload_rejects(read).collect()} == set(SPOILT)
    assert parse_payloads(read, ["Time"]).count() == sum(map(len, EXACT.values()))


def test_keys_leave_a_response_once(spark, plan):
    """The names of columns are found without a row per record."""
    body = json.dumps([RECORD] * 500)
    payloads = spark.createDataFrame([(body,), ('[{"New One":1}]',)], "payload string")
    found = payload_columns(payloads)
    text = plan(found).split("== Physical Plan ==")[1]
    assert {r["column"] for r in found.collect()} == {*RECORD, "New One"}
    assert text.count("Generate explode") == 1 and "array_distinct" in text


OTHER = "imd_Other"
DATASETS = {S.STATION_DATASET: None, S.AWS_DATASET: [*S.AWS_RAW, "RAIN"], OTHER: ["note"]}


def land_three(landing):
    for hour in range(3):
        label = f"2024-01-02T0{hour}-00-00"
        landing.add(label, [{**RECORD, "Time": hour}] * (hour + 1), age=500)
        landing.add(label, [AWS_RECORD, {**AWS_RECORD, "DATE": "x"}], code=S.AWS_DATASET, age=500)
        landing.add(label, [{"note": f"n{hour}", "BACKGROUND": "b"}], code=OTHER, age=500)
    landing.add("2024-01-02T01-00-00", "<html>503</html>", name="late", age=5)
    landing.add("2024-01-02T02-00-00", [RECORD], name="again", age=5)
    landing.add("2024-01-02T05-00-00", "<html>503</html>", code=S.AWS_DATASET, age=500)
    landing.add("2024-01-02T00-00-00", [{"note": "not ours"}], code="cds", age=500)


def test_run_over_all_datasets(spark, landing, tmp_path):
    """One run cleans every landed dataset, and returns the counts of its outcomes."""
    land_three(landing)
    out = tmp_path / "out"
    counts = clean_snapshots(spark, str(landing.folder), str(out), rejects=str(tmp_path / "rejects"))
    assert counts == {
        S.STATION_DATASET: {"responses": 5, "unreadable": 1, "superseded": 1, "rows": 4, "rejected_rows": 0},
        S.AWS_DATASET: {"responses": 4, "unreadable": 1, "superseded": 0, "rows": 6, "rejected_rows": 3},
        OTHER: {"responses": 3, "unreadable": 0, "superseded": 0, "rows": 3, "rejected_rows": 0},
    }
    found = rows_of(out)
    assert len(found) == 9 and not any("cds" in name for name in found)
    assert found[partition("01_00_00", OTHER)] == [{"note": "n1"}]
    assert len(found[partition("02_00_00")]) == 1
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2


def test_contents_are_read_once(spark, landing, tmp_path):
    """Rows, rejects and counts of a run come from one scan of the landed contents."""
    land_three(landing)
    seen = []
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    clean_snapshots(spark, str(landing.folder), str(tmp_path / "out"), rejects=str(tmp_path / "rejects"))
    runs = store.executionsList()
    for i in range(runs.size()):
        run = runs.apply(i)
        if run.executionId() >= before:
            seen.append(run.physicalPlanDescription())
    scans = [line for text in seen for line in text.splitlines() if "ReadSchema" in line and "content" in line]
    assert len(scans) == 1


def test_three_datasets_in_one_stream_out_of_order(spark, landing, tmp_path):
    """Files that land and are picked up in any order give what the batch run gives."""
    progress, out = str(tmp_path / "progress"), tmp_path / "stream"

    def run():
        stream_snapshots(
            spark, str(landing.folder), str(out), progress, DATASETS, rejects=str(tmp_path / "rejects"), files_per_batch=2
        ).awaitTermination()

    label = "2024-01-02T07-00-00"
    landing.add(label, [RECORD] * 2, name="later", age=50)
    run()
    # What had landed before is picked up afterwards, and so is a late error page.
    landing.add(label, [RECORD] * 7, name="earlier", age=900)
    landing.add(label, "<html>503</html>", name="page", age=1)
    land_three(landing)
    run()
    assert len(rows_of(out)[partition("07_00_00")]) == 2
    clean_snapshots(spark, str(landing.folder), str(tmp_path / "batch"), DATASETS)
    assert rows_of(out) == rows_of(tmp_path / "batch")
    lost = spark.read.json(str(tmp_path / "rejects"))
    assert lost.count() == 3


def test_odd_file_names(spark, landing, tmp_path):
    """Names that look like patterns are read as they are."""
    landing.add("2024-01-02T03-00-00", [RECORD], name="a[1]{x}*")
    landing.add("2024-01-02T04-00-00", [RECORD], name="b?%20 c")
    stream_snapshots(
        spark, str(landing.folder), str(tmp_path / "out"), str(tmp_path / "progress")
    ).awaitTermination()
    assert len(rows_of(tmp_path / "out")) == 2


def test_responses_land_by_many_tasks(spark, tmp_path):
    """Files are dealt out by number; by bytes all of them would be one task's work."""
    rows = spark.range(100).selectExpr("'[]' AS payload", "'imd_Other' AS datacode", "concat('t', id) AS timecode")
    files.write_responses(rows.coalesce(1), str(tmp_path))
    landed = [file.name.split("-")[1] for file in tmp_path.glob("datacode=imd_Other/timecode=*/part-*.txt")]
    assert len(landed) == 100 and len(set(landed)) > 8


def test_listing_takes_few_tasks(spark, landing):
    """Many folders are listed by a few tasks for every core, and the session's settings stay."""
    for minute in range(60):
        landing.add(f"2024-01-02T00-{minute:02}-00", [RECORD])
    context, before = spark.sparkContext, spark.conf.getAll
    context.setJobGroup("listing", "listing")
    assert landed_payloads(spark, str(landing.folder)).count() == 60
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(n) for job in tracker.getJobIdsForGroup("listing") for n in tracker.getJobInfo(job).stageIds]
    assert max(stage.numTasks for stage in stages) <= 4 * context.defaultParallelism < 60
    assert spark.conf.getAll == before


def test_state_partitions(spark, landing, tmp_path):
    """A stream's state has its own number of partitions; the session keeps its own for all else."""
    landing.add("2024-01-02T03-00-00", [RECORD])
    before, progress = spark.conf.getAll, tmp_path / "progress"
    stream_snapshots(spark, str(landing.folder), str(tmp_path / "out"), str(progress), state_partitions=3).awaitTermination()
    assert len(rows_of(tmp_path / "out")) == 1 and spark.conf.getAll == before
    assert sorted(p.name for p in (progress / "state" / "0").iterdir() if p.name.isdigit()) == ["0", "1", "2"]


def contents(path):
    """Bytes of the CSV files of each folder; two rows of one task are one file's."""
    found = {}
    for file in sorted(path.rglob("*.csv")):
        found.setdefault(str(file.parent.relative_to(path)), []).append(file.read_bytes())
    return found


ODD_VALUES = [*NOTES, "#c", "\u00fc \u65e5", "\t", " ", "a\x00b", "-1", '""', "x\\", "\n", "\r"]


def test_tasks_write_what_the_csv_writer_writes(spark, tmp_path, monkeypatch):
    """Tasks write their files themselves, byte by byte as Spark's writer does, without a side file for each."""
    rows = [
        (i, note, None if i % 2 else i / 3, "d:%1", None if i % 4 == 0 else "2024_01_02", "" if i % 7 == 0 else None if i % 5 == 1 else str(i % 5))
        for i, note in enumerate(ODD_VALUES)
    ]
    names = "`i, \"x` int, `no.te` string, v double, dataset string, snap_date string, snap_time string"
    df = spark.createDataFrame(rows, names).coalesce(1)
    for label, data in (("all", df), ("one", df.drop("i, \"x", "v"))):
        new, old = tmp_path / label / "new", tmp_path / label / "old"
        for _ in range(2):
            write_snapshots(data, str(new), gathered=True)
        with monkeypatch.context() as patched:
            patched.setattr(partitioned, "mounted_path", lambda spark, path: None)
            write_snapshots(data, str(old), gathered=True)
        assert contents(new) == contents(old) and len(contents(new)) > 5
        assert not [file for file in new.rglob("*") if file.name.startswith(".")]


def test_rows_of_a_folder_from_several_tasks(spark, tmp_path):
    """All files of a run stay; what an earlier run left in a folder goes, and other folders stay."""
    rows = spark.range(0, 60, 1, 4).selectExpr(
        "id", "'d' AS dataset", "'2024_01_02' AS snap_date", "concat('0', id % 3, '_00_00') AS snap_time"
    )
    write_snapshots(rows, str(tmp_path), gathered=True)
    write_snapshots(rows.where("id % 3 = 1"), str(tmp_path), gathered=True)
    assert {name: len(found) for name, found in rows_of(tmp_path).items()} == {
        partition(f"0{n}_00_00", "d"): 20 for n in range(3)
    }


def test_failed_run_leaves_what_was_there(spark, landing, tmp_path):
    out = tmp_path / "out"
    display = dict.fromkeys(S.DISPLAY_COLUMNS, "x")
    columns = [*S.STATION_RAW, *S.DISPLAY_COLUMNS]
    for hour in range(6):
        landing.add(f"2024-01-02T0{hour}-00-00", [{**RECORD, **display, "Time": hour}])
    clean_snapshots(spark, str(landing.folder), str(out), S.STATION_DATASET, columns, mode="strict")
    before = contents(out)
    for hour in range(6):
        landing.add(f"2024-01-02T0{hour}-00-00", [{**RECORD, **display, "Time": hour if hour < 5 else "x"}], name="later")
    with pytest.raises(Exception, match="cannot be read"):
        clean_snapshots(spark, str(landing.folder), str(out), S.STATION_DATASET, columns, mode="strict")
    assert len(before) == 6 and contents(out) == before
    assert not list(out.glob(".*"))


def test_moving_goes_on_where_it_broke_off(spark, tmp_path):
    staging, out = tmp_path / "out" / ".staging-r", tmp_path / "out"
    (staging / "a").mkdir(parents=True)
    (staging / "a" / "places").write_text(json.dumps(["d=1", "d=2"]))
    for number in (0, 1):
        (staging / "a" / str(number)).write_text(f"{number}")
    (out / "d=1").mkdir()
    (staging / "a" / "0").rename(out / "d=1" / "part-00003-r.c000.csv")
    for _ in range(2):
        mounted._mover(str(staging), str(out), "r", ".csv", True)(("a", 3))
    assert {f"{f.parent.name} {f.name}": f.read_text() for f in out.glob("d=*/*")} == {
        "d=1 part-00003-r.c000.csv": "0", "d=2 part-00003-r.c000.csv": "1",
    }


def test_a_response_is_parsed_once(spark, plan):
    payloads = spark.range(1).selectExpr("concat('[{\"a\":', id, '}]') AS payload")
    text = plan(read_payloads(payloads)).split("== Physical Plan ==")[1]
    assert text.lower().count("from_json(") + text.lower().count("from_json map") + text.lower().count("jsontostructs(") == 1
    assert readable_records("payload") is readable_records("payload")


def test_small_files_are_read_by_few_tasks(spark, landing):
    for minute in range(400):
        landing.add(f"2024-01-02T{minute // 60:02}-{minute % 60:02}-00", "[]")
    before = spark.conf.getAll
    with fewer_reading_tasks(spark):
        tasks = landed_payloads(spark, str(landing.folder)).rdd.getNumPartitions()
    assert tasks <= spark.sparkContext.defaultParallelism and spark.conf.getAll == before


def test_many_folders_are_read_by_their_paths(spark, landing, tmp_path, monkeypatch, plan):
    """Spark's reading of folder names takes the square of their number; by paths the rows are the same."""
    land_three(landing)
    landing.add("2024-01-02T06%3A00%3A00", [RECORD], name="b?%20 c")
    landing.add("__HIVE_DEFAULT_PARTITION__", [RECORD])
    landing.add("2024-01-02T04-00-00", [{"note": "n"}], code="imd_a+b%2Fc")

    def found():
        payloads = landed_payloads(spark, str(landing.folder))
        out = str(tmp_path / "out")
        back = read_snapshots(spark, out, "note string, dataset string, snap_date date, snap_time string")
        return (
            payloads.columns, sorted(map(str, payloads.collect())), back.dtypes, sorted(map(str, back.collect())),
            plan(payloads) + plan(back),
        )

    rows = spark.range(0, 40, 1, 4).selectExpr(
        "concat('n', id) AS note", "'a+ b:%1' AS dataset", "IF(id % 5 = 0, NULL, '2024-01-02') AS snap_date", "concat(id % 7, '_00') AS snap_time"
    )
    write_snapshots(rows, str(tmp_path / "out"))
    *few, text = found()
    assert "datacode" in text.split("PartitionFilters")[0] and "file_path" not in text
    monkeypatch.setattr(folders, "MANY_FOLDERS", 3)
    *many, text = found()
    assert many == few and "file_path" in text
    # Folders of other datasets are not read.
    wanted = plan(landed_payloads(spark, str(landing.folder)).filter("datacode = 'imd_Other'"))
    assert wanted.split("== Physical Plan ==")[1].count("FileScan") == 1
    clean_snapshots(spark, str(landing.folder), str(tmp_path / "many"), DATASETS)
    monkeypatch.undo()
    clean_snapshots(spark, str(landing.folder), str(tmp_path / "few"), DATASETS)
    assert rows_of(tmp_path / "many") == rows_of(tmp_path / "few")


def test_stream_does_not_look_at_folder_names(spark, landing, tmp_path):
    landing.add("2024-01-02T03-00-00", [RECORD])
    files = landed_payloads(spark, str(landing.folder), stream=True)
    text = files._jdf.queryExecution().analyzed().toString()
    assert "regexp_extract" in text.lower() and files.columns[:3] == ["payload", "datacode", "timecode"]
