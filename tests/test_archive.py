from __future__ import annotations

import json

import pytest

from eventloom.sources import archive
from tests.conftest import line, rows, write_hour


def ids(df):
    return sorted(int(r.id) for r in df.select("id").collect())


def test_malformed_lines_are_marked(parsed):
    good = line(1)
    bad = [good[:-5], "", "  ", "null", "[1, 2]", "[{}]", "3", "{'id': 4}"]
    bad += [f"{good} more", f"{good}{good}", f"{good},{good}"]
    odd = [line(6, actor=7, org=None, payload="absent"), "{}", '{"id": 5, "actor": "x"}', f"{good} "]
    found = parsed(good, *bad, *odd).orderBy("line_no").collect()
    assert [r.malformed for r in found] == [False] + [True] * len(bad) + [False] * len(odd)


def test_numbers_and_text_both_serve_as_id(parsed):
    assert ids(archive.well_formed(parsed(line(1), line(1).replace('"1"', "2")))) == [1, 2]


def test_day_reads_unpadded_hours_and_ignores_missing_ones(spark, tmp_path):
    write_hour(tmp_path, "2024-01-05-3", [line(1), line(2)])
    write_hour(tmp_path, "2024-01-05-13", [line(3)])
    write_hour(tmp_path, "2024-01-06-3", [line(4)])
    root = str(tmp_path)
    assert ids(archive.ingest_day(spark, root, "2024-01-05")) == [1, 2, 3]
    assert ids(archive.ingest_hour(spark, root, "2024-01-05", 3)) == [1, 2]
    assert ids(archive.ingest_range(spark, root, "2024-01-05", "2024-01-06")) == [1, 2, 3, 4]
    assert archive.ingest_day(spark, root, "2024-02-01").count() == 0


def test_lines_keep_hour_and_position(spark, tmp_path):
    write_hour(tmp_path, "2024-01-05-3", [line(n) for n in (9, 7, 8)])
    write_hour(tmp_path, "2024-01-05-2", [line(n) for n in (5, 6)])
    day = archive.ingest_day(spark, str(tmp_path), "2024-01-05")
    ordered = day.orderBy("archive_hour", "line_no").select("id").collect()
    assert [r.id for r in ordered] == ["5", "6", "9", "7", "8"]


def test_damaged_hour_is_left_out_whole(spark, tmp_path):
    for hour in (0, 1, 2, 5, 23):
        lines = [line(hour * 1000 + n, note="x" * (n % 50)) for n in range(500)]
        write_hour(tmp_path, f"2024-01-05-{hour}", lines, keep=800 if hour in (1, 23) else None)
    found = ids(archive.ingest_day(spark, str(tmp_path), "2024-01-05"))
    assert found == [h * 1000 + n for h in (0, 2, 5) for n in range(500)]


def test_hour_must_be_valid_and_present(spark, tmp_path):
    with pytest.raises(ValueError):
        archive.ingest_hour(spark, str(tmp_path), "2024-01-05", 24)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        archive.ingest_hour(spark, str(tmp_path), "2024-01-05", 3).count()


def test_nested_payload_stays_json(parsed):
    payload = {"push_id": 1, "commits": [{"sha": "a"}]}
    text = parsed(line(1, payload=payload)).first().payload
    assert json.loads(text) == payload
    assert rows(parsed(line(2)).select("payload")) == [("{}",)]


def test_report_names_every_hour(spark, tmp_path):
    for hour in (0, 2, 3):
        lines = [line(hour * 1000 + n, note="x" * (n % 50)) for n in range(500)]
        write_hour(tmp_path, f"2024-01-05-{hour}", lines, keep=800 if hour == 2 else None)
    report = {r.archive_hour.hour: r for r in archive.ingest_report(spark, str(tmp_path), "2024-01-05", "2024-01-05").collect()}
    assert {h: r.state for h, r in report.items()} == {h: {0: "loaded", 2: "damaged", 3: "loaded"}.get(h, "missing") for h in range(24)}
    assert (report[0].lines, report[2].lines, report[1].lines) == (500, 0, 0)
    assert "FAILED_READ_FILE" in report[2].error and report[1].error is None
    nothing = archive.ingest_report(spark, str(tmp_path), "2024-02-01", "2024-02-02")
    assert rows(nothing.groupBy("state").count()) == [("missing", 48)]
