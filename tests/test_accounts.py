"""Tallies, verdicts, ledgers and report texts, on stated cases."""

import pytest
from pyspark.errors import PySparkException

from barograph.operators import accounting, report
from barograph.sources import file_inventory


def test_tally_and_status(spark):
    transfers = spark.createDataFrame(
        [("a", True), ("a", False), ("a", True), ("b", True)], "prefix string, ok boolean"
    )
    tally = {r["prefix"]: tuple(r)[1:] for r in accounting.transfer_tally(transfers).collect()}
    assert tally == {"a": (3, 2, 1), "b": (1, 1, 0)}
    prefixes = spark.createDataFrame([("a",), ("c",), ("c",)], "prefix string")
    status = accounting.prefix_status(prefixes, transfers).collect()
    assert {r["prefix"]: (r["total"], r["ok"]) for r in status} == {"a": (3, False), "b": (1, True), "c": (0, True)}


def test_run_status(spark):
    schema = "region string, ok boolean, n_files bigint, latest timestamp_ntz"
    none = accounting.run_status(spark.createDataFrame([], schema)).first()
    assert (none["ok"], none["n_files"], none["latest"]) == (True, 0, None)
    some = spark.createDataFrame([("a", True, 2, None), ("b", False, 3, None)], schema)
    assert tuple(accounting.run_status(some).first())[:2] == (False, 5)


@pytest.mark.parametrize(
    "codes, outcome",
    [([404, 404, 200], "ok"), ([403], "failed"), ([503], "failed"), ([500] * 11, "exhausted"),
     ([500] * 10, "retrying"), ([None], "retrying"), ([None] * 11, "exhausted"), ([200, 403], "failed")],
)
def test_attempts(spark, codes, outcome):
    log = spark.createDataFrame(
        [("f", i, code) for i, code in enumerate(codes)], "file string, attempt int, status_code int"
    )
    row = accounting.attempt_outcomes(log).first()
    assert (row["attempts"], row["status_code"], row["outcome"]) == (len(codes), codes[-1], outcome)
    strict = accounting.attempt_outcomes(log, strict=True)
    if outcome in ("failed", "exhausted"):
        with pytest.raises(PySparkException, match="transfer failed"):
            strict.collect()
    else:
        assert strict.first()["outcome"] == outcome


def test_ledger(spark):
    expected = spark.createDataFrame([("p/a",), ("p/b",), ("p/b",)], "key string")
    found = spark.createDataFrame([("p/a",), ("p/a",), ("q/z",)], "key string")
    ledger = accounting.delivery_ledger(expected, found)
    rows = sorted(map(tuple, ledger.collect()))
    assert rows == [("p", "p/a", True, None), ("p", "p/b", False, "not found at destination")]
    assert tuple(accounting.transfer_tally(ledger).first()) == ("p", 2, 1, 1)
    with pytest.raises(PySparkException, match="not delivered: p/b"):
        accounting.delivery_ledger(expected, found, strict=True).collect()


def test_inventory_reads_no_contents(spark, tmp_path, plan):
    for name, size in (("a.nc", 3), ("b.nc", 5), ("xnc", 7), ("c.txt", 9)):
        (tmp_path / name).write_bytes(b"x" * size)
    files = file_inventory(spark, str(tmp_path), "nc")
    assert sorted(r["length"] for r in files.collect()) == [3, 5]
    assert "content" not in plan(files).split("ReadSchema")[1]
    counts = accounting.file_counts(file_inventory(spark, str(tmp_path)), "nc").collect()
    assert [(r["ext"], r["n_files"], r["n_bytes"]) for r in counts] == [("nc", 2, 8)]


def test_report(spark):
    schema = "job string, run_date string, seq int, component string, status string, comments string"
    entries = spark.createDataFrame(
        [("J", "20240131", 1, "a", "SUCCESS", "x"), ("J", "20240131", 2, "b", "CRITICAL", "y"),
         ("J", "20240131", 3, "c", "ERROR", "z"), ("K", "20240131", 1, "a", "SUCCESS", "x")], schema,
    )
    subjects = {r["job"]: r["subject"] for r in report.report_subject(entries).collect()}
    assert subjects == {
        "J": "Errors raised - CRITICAL ERROR!! - J || 20240131", "K": "K || 20240131",
    }
    colours = [r["colour"] for r in report.report_rows(entries).orderBy("job", "seq").collect()]
    assert colours == ["green", "red", "orange", "green"]
    empty = report.report_flags(entries.filter("seq > 9"), by=()).first()
    assert tuple(empty) == (False, False)


def test_any_status_is_kept(spark):
    log = spark.createDataFrame([("f", 1, 1001), ("g", 2, None), ("g", 1, 200)], "file string, attempt int, status_code int")
    rows = {r["file"]: r for r in accounting.attempt_outcomes(log).collect()}
    assert (rows["f"]["status_code"], rows["f"]["outcome"]) == (1001, "failed")
    assert (rows["g"]["status_code"], rows["g"]["outcome"]) == (None, "retrying")


def test_tallies_at_every_level(spark, plan):
    """Whole, dataset and prefix from one grouping, with what was listed but never tried."""
    listed = spark.createDataFrame([("d", "d/a", "D"), ("d", "d/b", "D"), ("e", "e/a", "E")], "dataset string, prefix string, label string")
    transfers = spark.createDataFrame(
        [("d", "d/a", True), ("d", "d/a", None), ("e", "e/a", True), (None, None, False)], "dataset string, prefix string, ok boolean"
    )
    levels = accounting.tally_levels(listed, transfers, ["dataset", "prefix"], ["label"])
    assert plan(levels).split("== Physical Plan ==")[1].count("Exchange") == 1
    found = {
        (r["level"], r["dataset"], r["prefix"]): (r["total"], r["succeeded"], r["failed"], r["label"], r["ok"])
        for r in levels.collect()
    }
    assert found == {
        (0, None, None): (4, 2, 2, "E", False),
        (1, "d", None): (2, 1, 1, "D", False), (1, "e", None): (1, 1, 0, "E", True), (1, None, None): (1, 0, 1, None, False),
        (2, "d", "d/a"): (2, 1, 1, "D", False), (2, "d", "d/b"): (0, 0, 0, "D", True),
        (2, "e", "e/a"): (1, 1, 0, "E", True), (2, None, None): (1, 0, 1, None, False),
    }


def test_last_attempt_by_hash_aggregate(spark, plan):
    """Equal attempt numbers are settled by status, whatever the order of rows."""
    log = [("f", 3, 200), ("f", 3, 500), ("f", 2, 900), ("g", 2**40, None), ("g", 1, 200), ("h", None, 404), ("h", 1, 200)]
    for rows in (log, log[::-1]):
        df = spark.createDataFrame(rows, "file string, attempt bigint, status_code int")
        outcomes = accounting.attempt_outcomes(df)
        assert {r["file"]: (r["attempts"], r["status_code"]) for r in outcomes.collect()} == {"f": (3, 500), "g": (2, None), "h": (2, 200)}
    text = plan(outcomes)
    assert "SortAggregate" not in text and "HashAggregate" in text
