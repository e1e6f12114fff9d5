from __future__ import annotations

import json
import tempfile

import pytest

from shelfroll.sources.params import JobParamsError, clean_list, params_frame, parse_date_range, read_params

BASE = {
    "aggregateBaseUri": "/tmp/out/",
    "aggregationLevel": "StoreItem",
    "aggregationType": "Day",
    "retailer": "[r1]",
    "vendors": [1],
    "jobId": 1,
    "factBaseUri": "/tmp/fact/",
    "dimBaseUri": "/tmp/[dim]/",
    "calendarId": "c1",
    "osaFactBaseURI": "/tmp/osa/",
    "subject": "FACT",
    "loadType": "FL",
    "dateRange": "20000131,20000101",
    "kafkaServer": "",
    "kafkaTopic": "",
}


def _write(doc) -> str:
    f = tempfile.NamedTemporaryFile("w", suffix=".json", delete=False)
    json.dump(doc, f, indent=2)
    f.close()
    return f.name


def test_valid_document(spark):
    p = read_params(spark, _write(BASE))
    assert (p.start, p.end) == (20000101, 20000131)
    assert p.retailer == "r1"  # brackets stripped
    assert p.dim_base_uri == "/tmp/[dim]/"  # kept
    assert p.vendors == [1] and p.job_id == 1 and p.load_type == "FL"
    assert p.fact_path == "/tmp/osa/r1/FACT/"
    assert p.staging_path == "/tmp/out/r1/staging/"
    row = params_frame(spark, _write(BASE)).first()
    assert row["vendors"] == [1] and row["jobId"] == 1


def test_two_vendors_as_array_or_text(spark):
    assert read_params(spark, _write({**BASE, "vendors": [1, 2]})).vendors == [1, 2]
    assert read_params(spark, _write({**BASE, "vendors": "[1, 2]"})).vendors == [1, 2]


@pytest.mark.parametrize("n_fields", [14, 16])
def test_field_count_must_be_15(spark, n_fields):
    doc = dict(BASE)
    if n_fields == 14:
        doc.pop("kafkaTopic")
    else:
        doc["extra"] = "x"
    with pytest.raises(JobParamsError):
        read_params(spark, _write(doc))


@pytest.mark.parametrize("doc", [[], [BASE, BASE]])
def test_exactly_one_object(spark, doc):
    with pytest.raises(JobParamsError):
        read_params(spark, _write(doc))


def test_unknown_load_type_and_bad_ranges(spark):
    with pytest.raises(JobParamsError, match="load type"):
        read_params(spark, _write({**BASE, "loadType": "XX"}))
    with pytest.raises(JobParamsError):
        parse_date_range("20000101,20000131")  # start after end
    with pytest.raises(JobParamsError):
        parse_date_range("2000-01-31,2000-01-01")
    assert parse_date_range("[20000131, 20000101]") == (20000101, 20000131)


def test_clean_list_driver_side():
    assert clean_list("[a, b,]") == ["a", "b"]
    assert clean_list(",a,,b") == ["", "a", "", "b"]
    assert clean_list("") == [""]
    assert clean_list(",,,") == []
