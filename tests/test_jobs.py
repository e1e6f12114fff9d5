from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import shutil
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfroll import schema as S
from shelfroll.operators.weekly import build_weekly
from shelfroll.plans import jobs, sinks
from shelfroll.plans.runlog import FAILED, IN_PROGRESS, SUCCESS, RunLog, latest_status
from shelfroll.plans.scope import job_scope, merge_ranges
from shelfroll.sources.params import JobParams, JobParamsError
from shelfroll.sources.tables import dim_path, read_daily, read_staging, read_weekly

from .conftest import key, make_calendar

AS_OF = 20010101


def _fact(spark, rows):
    full = [tuple([1, v, p, 1, 1, 1] + [u, u * 2, 0.0, 0.0, u, 0.0, u, 1.5]) for v, p, u in rows]
    return spark.createDataFrame(full, S.FACT_SCHEMA)


def _setup(spark):
    base = tempfile.mkdtemp(prefix="job-")
    make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 12, 31)).write.parquet(dim_path(base, "r1", "calendar"))
    rows = []
    for v in (1, 2):
        for d in range(1, 15):
            rows.append((v, key(dt.date(1999, 1, d)), float(d)))
            rows.append((v, key(dt.date(2000, 1, d)), float(10 + d)))
    fact_path = f"{base}/osa/r1/fact/"
    sinks.write_partitioned(_fact(spark, rows), fact_path, S.DAILY_PARTITIONS, "full")
    return base


def _params(base, load_type, start, end, vendors=(1, 2)) -> JobParams:
    return JobParams(
        aggregate_base_uri=f"{base}/out/", aggregation_level="StoreItem", aggregation_type="Day", retailer="r1",
        vendors=list(vendors), job_id=7, fact_base_uri=f"{base}/osa/", dim_base_uri=base, calendar_id="c1",
        osa_fact_base_uri=f"{base}/osa/", subject="fact", load_type=load_type, start=start, end=end,
    )


def _md5s(root):
    out = {}
    for d, _, fs in os.walk(root):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[os.path.relpath(p, root)] = hashlib.md5(open(p, "rb").read()).hexdigest()
    return out


def test_full_then_incremental_load(spark):
    base = _setup(spark)
    p = _params(base, "FL", 19990101, 20001231)
    log = jobs.run_job(spark, p, as_of=AS_OF)
    assert [r[4] for r in log.rows if r[4] != IN_PROGRESS] == [SUCCESS] * 4
    stg = read_staging(spark, p.staging_path)
    assert stg.count() == 56
    daily = read_daily(spark, p.daily_path)
    d = {(r[S.VENDOR], r[S.PERIOD]): r for r in daily.collect()}
    # 2000-01-05 has LY 1999-01-06 (364 days back): units 6
    assert (d[(1, 20000105)]["total_units_ty"], d[(1, 20000105)]["total_units_ly"]) == (15.0, 6.0)
    weekly = read_weekly(spark, p.weekly_path)
    assert weekly.agg(F.sum("total_units_ty")).first()[0] == daily.agg(F.sum("total_units_ty")).first()[0]
    assert spark.read.orc(p.log_path).count() == 7

    # IL: vendor 1's 1999-01-06 changes; its LY users (2000-01-05) must follow
    daily_before = _md5s(p.daily_path)
    weekly_before = _md5s(p.weekly_path)
    sinks.write_partitioned(_fact(spark, [(1, 19990106, 100.0)]), p.fact_path, S.DAILY_PARTITIONS, "upsert")
    il = _params(base, "IL", 19990106, 19990106, vendors=(1,))
    jobs.run_job(spark, il, as_of=AS_OF)
    d2 = {(r[S.VENDOR], r[S.PERIOD]): r for r in read_daily(spark, p.daily_path).collect()}
    assert d2[(1, 19990106)]["total_units_ty"] == 100.0
    assert d2[(1, 20000105)]["total_units_ly"] == 100.0
    assert d2[(2, 20000105)]["total_units_ly"] == 6.0
    assert len(d2) == len(d)
    daily_after = _md5s(p.daily_path)
    changed = {k.split("/part-")[0] for k in daily_after if daily_before.get(k) != daily_after[k]}
    # only the job vendor's rebuilt days were rewritten: the changed day and the day using it as LY
    assert changed == {f"vendor_key=1/period_key={k}" for k in (19990106, 20000105)}
    weekly_after = _md5s(p.weekly_path)
    wchanged = {k.split("/part-")[0] for k in weekly_after if weekly_before.get(k) != weekly_after[k]}
    assert wchanged == {"vendor_key=1/week_ended=1999-01-09", "vendor_key=1/week_ended=2000-01-08"}
    w = {(r[S.VENDOR], r[S.WEEK_ENDED]): r for r in read_weekly(spark, p.weekly_path).collect()}
    assert w[(1, dt.date(2000, 1, 8))]["total_units_ly"] == sum(
        d2[(1, k)]["total_units_ly"] for k in range(20000102, 20000109)
    )
    assert spark.read.orc(p.log_path).count() == 14


@pytest.mark.parametrize("load_type", ["FR", "IR"])
def test_refresh_types_skip_staging(spark, load_type):
    base = _setup(spark)
    jobs.run_job(spark, _params(base, "FL", 19990101, 20001231), as_of=AS_OF)
    p = _params(base, load_type, 20000101, 20000114)
    log = jobs.run_job(spark, p, as_of=AS_OF)
    assert "not required" in log.rows[1][2]
    assert log.rows[-1][4] == SUCCESS
    daily = read_daily(spark, p.daily_path)
    periods = {r[S.PERIOD] for r in daily.select(S.PERIOD).distinct().collect()}
    if load_type == "FR":  # full overwrite: only the whole weeks of the refreshed range remain
        assert min(periods) >= 19991226
    else:
        assert min(periods) == 19990101


def test_bad_parameters_are_logged_and_raised(spark):
    base = tempfile.mkdtemp(prefix="job-")
    doc = {f: "x" for f in S.PARAM_FIELDS}
    doc.update({"vendors": [1], "jobId": 1, "dateRange": "20000131,20000101", "loadType": "ZZ"})
    path = os.path.join(base, "p.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    with pytest.raises(JobParamsError):
        jobs.run_from_file(spark, path, log_path=f"{base}/log")
    rows = spark.read.orc(f"{base}/log").collect()
    assert len(rows) == 1 and rows[0]["Status"] == FAILED


def test_failure_is_logged(spark):
    base = tempfile.mkdtemp(prefix="job-")  # no calendar, no facts
    p = _params(base, "FR", 20000101, 20000131)
    with pytest.raises(Exception):
        jobs.run_job(spark, p, as_of=AS_OF)
    rows = spark.read.orc(p.log_path).collect()
    assert sorted(r["Status"] for r in rows) == [FAILED, SUCCESS]


def test_merge_ranges():
    assert merge_ranges([(5, 9), (1, 3), (3, 4), (20, 30)]) == [(1, 4), (5, 9), (20, 30)]


def _drop_fact_days(p, days, vendors=(1, 2)):
    for v in vendors:
        for k in days:
            shutil.rmtree(f"{p.fact_path}/vendor_key={v}/period_key={k}")


def _ty_days(spark, path):
    return {r[S.PERIOD] for r in read_daily(spark, path).where("total_units_ty > 0").collect()}


def test_full_load_removes_staging_without_facts(spark):
    base = _setup(spark)
    p = _params(base, "FL", 19990103, 19990104)
    jobs.run_job(spark, p, as_of=AS_OF)
    week = set(range(19990103, 19990110))
    assert _ty_days(spark, p.daily_path) == week
    _drop_fact_days(p, [19990104])
    log = jobs.run_job(spark, p, as_of=AS_OF)
    assert {r[S.PERIOD] for r in read_staging(spark, p.staging_path).collect()} == week - {19990104}
    assert _ty_days(spark, p.daily_path) == week - {19990104}
    assert any("2 partition(s) without facts removed" in r[2] for r in log.rows)
    # another vendor's staging in the same days is none of this job's
    jobs.run_job(spark, _params(base, "FL", 19990103, 19990104, vendors=(1,)), as_of=AS_OF)
    assert {r[S.VENDOR] for r in read_staging(spark, p.staging_path).collect()} == {1, 2}
    # nor are days beyond its range, even of the weeks it loads
    _drop_fact_days(p, [19990105])
    jobs.run_job(spark, p, as_of=AS_OF)
    assert {r[S.PERIOD] for r in read_staging(spark, p.staging_path).collect()} == week - {19990104}


def test_full_load_from_mid_week_builds_whole_weeks(spark):
    """Facts of 1-22 January 2000 (and a year earlier), FL for 5-12 January: two weeks of seven days, LY included."""
    base = _setup(spark)
    rows = [(1, key(dt.date(2000, 1, 1) + dt.timedelta(days=i)), 1.0) for i in range(22)]
    rows += [(1, key(dt.date(1999, 1, 1) + dt.timedelta(days=i)), 2.0) for i in range(22)]
    fact = f"{base}/osa/r1/fact/"
    sinks.write_partitioned(_fact(spark, rows), fact, S.DAILY_PARTITIONS, "full")
    p = _params(base, "FL", 20000105, 20000112, vendors=(1,))
    jobs.run_job(spark, p, as_of=AS_OF)
    weekly = {r[S.WEEK_ENDED]: (r["total_units_ty"], r["total_units_ly"]) for r in read_weekly(spark, p.weekly_path).collect()}
    assert weekly == {dt.date(2000, 1, 8): (7.0, 14.0), dt.date(2000, 1, 15): (7.0, 14.0)}
    staged = {r[S.PERIOD] for r in read_staging(spark, p.staging_path).collect()}
    assert staged == {key(dt.date(2000, 1, 2) + dt.timedelta(days=i)) for i in range(14)} | {
        key(dt.date(1999, 1, 3) + dt.timedelta(days=i)) for i in range(14)
    }


@pytest.mark.parametrize("load_type", ["IL", "FL"])
def test_a_vanished_fact_day_leaves_no_row(spark, load_type):
    """Facts of one day removed, then a load of the days around it: no stage keeps the day or what came from it."""
    base = _setup(spark)
    jobs.run_job(spark, _params(base, "FL", 19990101, 20001231), as_of=AS_OF)
    p = _params(base, load_type, 19990106, 19990108)
    _drop_fact_days(p, [19990107])
    log = jobs.run_job(spark, p, as_of=AS_OF)
    assert 19990107 not in {r[S.PERIOD] for r in read_staging(spark, p.staging_path).collect()}
    daily = {(r[S.VENDOR], r[S.PERIOD]): r for r in read_daily(spark, p.daily_path).collect()}
    assert not any(k == 19990107 and r["total_units_ty"] > 0 for (_, k), r in daily.items())
    if load_type == "IL":
        # the day a year later has lost its last year, the week its units
        assert daily[(1, 20000106)]["total_units_ly"] == 0.0 and daily[(1, 20000105)]["total_units_ly"] == 6.0
        weekly = {(r[S.VENDOR], r[S.WEEK_ENDED]): r for r in read_weekly(spark, p.weekly_path).collect()}
        assert weekly[(1, dt.date(1999, 1, 9))]["total_units_ty"] == 3 + 4 + 5 + 6 + 8 + 9
        assert weekly[(1, dt.date(2000, 1, 8))]["total_units_ly"] == 3 + 4 + 5 + 6 + 8 + 9
    assert any("2 partition(s) without facts removed" in r[2] for r in log.rows)


def test_a_week_without_days_goes(spark):
    base = _setup(spark)
    jobs.run_job(spark, _params(base, "FL", 19990101, 20001231), as_of=AS_OF)
    p = _params(base, "IL", 20000109, 20000115, vendors=(2,))
    _drop_fact_days(p, range(20000109, 20000115), vendors=(2,))
    _drop_fact_days(p, range(19990110, 19990115), vendors=(2,))
    jobs.run_job(spark, _params(base, "IL", 19990110, 19990116, vendors=(2,)), as_of=AS_OF)
    log = jobs.run_job(spark, p, as_of=AS_OF)
    weeks = {(r[S.VENDOR], r[S.WEEK_ENDED]) for r in read_weekly(spark, p.weekly_path).collect()}
    assert (2, dt.date(2000, 1, 15)) not in weeks and (1, dt.date(2000, 1, 15)) in weeks
    assert "partition(s) without rows removed" in log.rows[-1][2]


def test_job_scope_is_a_closure_over_the_calendar(spark):
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2001, 12, 31)).cache()
    full = job_scope(cal, 20000105, 20000112, False)
    assert full.weeks == full.daily == [(20000102, 20000115)]
    assert full.staging == [(19990103, 19990116), (20000102, 20000115)] and full.own == (20000105, 20000112)
    upsert = job_scope(cal, 20000105, 20000112, True)
    assert upsert.staging == [(20000105, 20000112)]
    assert upsert.daily == [(20000105, 20000112), (20010103, 20010110)]
    assert upsert.weeks == [(20000102, 20000115), (20001231, 20010113)]
    with pytest.raises(ValueError, match="no day between"):
        job_scope(cal, 20100101, 20100102, False)


def test_every_step_is_stored_when_it_happens(spark):
    base = _setup(spark)
    p = _params(base, "FL", 19990101, 20001231)
    seen = []
    keep = sinks.append_job_log
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sinks, "append_job_log", lambda df, path: (keep(df, path), seen.append(spark.read.orc(path).count())))
        jobs.run_job(spark, p, as_of=AS_OF)
    assert seen == [1, 2, 3, 4, 5, 6, 7]
    status = {(r.JobId, r.stage): r.Status for r in latest_status(spark.read.schema(S.JOB_LOG_SCHEMA).orc(p.log_path)).collect()}
    assert status == {(7, s): SUCCESS for s in ("Parameters", "Staging", "Daily", "Weekly")}


KILLED_JOB = """
import os, sys
sys.path.insert(0, {repo!r})
from shelfroll.session import local_session
from shelfroll.plans import jobs
from shelfroll.sources.params import JobParams
spark = local_session(2)
jobs.build_daily = lambda *a, **k: os._exit(9)
jobs.run_job(spark, JobParams(**{params!r}), as_of=20010101)
"""


def test_a_killed_job_leaves_its_step_in_progress(spark):
    base = _setup(spark)
    p = _params(base, "FL", 19990101, 19990114)
    fields = {f: getattr(p, f) for f in p.__dataclass_fields__}
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_ENV"))}
    out = subprocess.run([sys.executable, "-c", KILLED_JOB.format(repo=repo, params=fields)], env=env, capture_output=True, timeout=240)
    assert out.returncode == 9, out.stderr[-2000:]
    log = spark.read.schema(S.JOB_LOG_SCHEMA).orc(p.log_path)
    status = {r.stage: r.Status for r in latest_status(log).collect()}
    assert status == {"Parameters": SUCCESS, "Staging": SUCCESS, "Daily": IN_PROGRESS}
    # the run that follows shows as the later one
    jobs.run_job(spark, p, as_of=AS_OF)
    assert {r.Status for r in latest_status(log.sparkSession.read.schema(S.JOB_LOG_SCHEMA).orc(p.log_path)).collect()} == {SUCCESS}


def test_latest_status_of_ties_and_odd_rows(spark):
    rows = [
        (1, "Step 9", "Daily full started", "t", IN_PROGRESS), (1, "Step 10", "Daily full done", "t", SUCCESS),
        (1, "Step 2", "Daily full started", "u", IN_PROGRESS), (None, "no number", "Daily", None, FAILED), (2, None, None, None, None),
    ]
    got = {(r.JobId, r.stage): r.Status for r in latest_status(spark.createDataFrame(rows, S.JOB_LOG_SCHEMA)).collect()}
    assert got == {(1, "Daily"): IN_PROGRESS, (None, "Daily"): FAILED, (2, None): None}
    assert latest_status(RunLog(1).to_df(spark)).count() == 0


@pytest.mark.parametrize("load_type", ["FR", "FL"])
def test_full_types_never_build_a_week_from_part_of_its_days(spark, load_type):
    base = _setup(spark)
    rows = [(1, k, 1.0) for k in range(19991226, 19991232)]
    sinks.write_partitioned(_fact(spark, rows), f"{base}/osa/r1/fact/", S.DAILY_PARTITIONS, "upsert")
    jobs.run_job(spark, _params(base, "FL", 19990101, 20001231), as_of=AS_OF)
    whole = {(r[S.VENDOR], r[S.WEEK_ENDED]): r["total_units_ty"] for r in read_weekly(spark, f"{base}/out/r1/weekly/").collect()}
    # 2000-01-01 is the last day of its week
    p = _params(base, load_type, 20000101, 20000131)
    jobs.run_job(spark, p, as_of=AS_OF)
    part = {(r[S.VENDOR], r[S.WEEK_ENDED]): r["total_units_ty"] for r in read_weekly(spark, p.weekly_path).collect()}
    assert part[(1, dt.date(2000, 1, 1))] == whole[(1, dt.date(2000, 1, 1))] == 17.0
    assert all(whole[k] == v for k, v in part.items())


@pytest.mark.parametrize("load_type", ["FL", "FR", "IL", "IR"])
def test_range_outside_the_calendar_is_rejected_before_any_write(spark, load_type):
    base = _setup(spark)
    full = _params(base, "FL", 19990101, 20001231)
    jobs.run_job(spark, full, as_of=AS_OF)
    before = {p: _md5s(p) for p in (full.staging_path, full.daily_path, full.weekly_path)}
    with pytest.raises(ValueError, match="no day between"):
        jobs.run_job(spark, _params(base, load_type, 20100101, 20101231), as_of=AS_OF)
    assert before == {p: _md5s(p) for p in before}


def test_failed_full_write_leaves_the_old_table(spark):
    base = _setup(spark)
    p = _params(base, "FL", 19990101, 20001231)
    jobs.run_job(spark, p, as_of=AS_OF)
    before = _md5s(p.daily_path)
    broken = read_daily(spark, p.daily_path).withColumn("total_units_ty", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        sinks.write_daily(broken, p.daily_path, "full")
    assert _md5s(p.daily_path) == before
    assert [n for n in os.listdir(f"{base}/out/r1") if "__new" in n] == []


def test_rejected_parameters_are_logged_by_default(spark):
    base = tempfile.mkdtemp(prefix="job-")
    doc = {f: "x" for f in S.PARAM_FIELDS}
    doc.update({"vendors": [1], "jobId": 1, "dateRange": "20000131,20000101", "loadType": "ZZ", "aggregateBaseUri": f"{base}/out/", "retailer": "r9"})
    path = os.path.join(base, "p.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    with pytest.raises(JobParamsError):
        jobs.run_from_file(spark, path)
    assert [r["Status"] for r in spark.read.orc(f"{base}/out/r9/job_logs/").collect()] == [FAILED]


def test_started_stages_are_logged_before_they_end(spark):
    base = _setup(spark)
    log = jobs.run_job(spark, _params(base, "FL", 19990101, 20001231), as_of=AS_OF)
    assert [r[4] for r in log.rows] == [SUCCESS, IN_PROGRESS, SUCCESS, IN_PROGRESS, SUCCESS, IN_PROGRESS, SUCCESS]
    assert "56 rows" in log.rows[2][2]


def test_command_line_entry(spark, capsys):
    from shelfroll.__main__ import main

    base = _setup(spark)
    doc = {
        "aggregateBaseUri": f"{base}/out/", "aggregationLevel": "StoreItem", "aggregationType": "Day",
        "retailer": "r1", "vendors": [1, 2], "jobId": 9, "factBaseUri": f"{base}/osa/", "dimBaseUri": base,
        "calendarId": "c1", "osaFactBaseURI": f"{base}/osa/", "subject": "fact", "loadType": "FL",
        "dateRange": "20001231,19990101", "kafkaServer": "", "kafkaTopic": "",
    }
    path = os.path.join(base, "job.json")
    with open(path, "w") as f:
        json.dump(doc, f, indent=2)
    assert main([path, "--as-of", "2001-01-01"]) == 0
    out = capsys.readouterr().out
    assert out.count("Success") == 4 and out.count("In-Progress") == 3
    assert read_weekly(spark, f"{base}/out/r1/weekly/").count() > 0
    bad = dict(doc, loadType="QQ")
    with open(path, "w") as f:
        json.dump(bad, f)
    assert main([path]) == 1


def test_upsert_removes_partitions_it_has_no_rows_for(spark):
    base = _setup(spark)
    jobs.run_job(spark, _params(base, "FL", 19990101, 20001231), as_of=AS_OF)
    # 1999-12-31 holds only LY values (shifted from 1999-01-01); with the window
    # ending before that day, a refresh produces no rows for it
    p = _params(base, "IR", 19991231, 19991231, vendors=(1,))
    log = jobs.run_job(spark, p, as_of=19991231)
    daily_step = [r[2] for r in log.rows if r[2].startswith("Daily upsert done")][0]
    assert "1 partition(s) without rows removed" in daily_step
    weekly_step = [r[2] for r in log.rows if r[2].startswith("Weekly upsert done")][0]
    assert "partition(s)" not in weekly_step
    assert read_daily(spark, p.daily_path, 19991231, 19991231, [1]).count() == 0
    assert read_daily(spark, p.daily_path, 19991231, 19991231, [2]).count() == 1


def _weeks(spark, p):
    return sorted(tuple(r) for r in read_weekly(spark, p.weekly_path).collect())


def _rebuilt(spark, p):
    return sorted(tuple(r) for r in build_weekly(read_daily(spark, p.daily_path)).select(*S.WEEKLY_COLUMNS).collect())


def test_upserts_follow_the_changed_days_and_equal_a_rebuild(spark):
    """Weekly after each upsert equals one built from the whole daily table, and reads no other day."""
    base = _setup(spark)
    p = _params(base, "FL", 19990101, 20001231)
    jobs.run_job(spark, p, as_of=AS_OF)
    assert _weeks(spark, p) == _rebuilt(spark, p)
    for day, vendor, units in ((19990106, 1, 100.0), (19990106, 1, 0.0), (20000112, 2, 3.5)):
        sinks.write_partitioned(_fact(spark, [(vendor, day, units)]), p.fact_path, S.DAILY_PARTITIONS, "upsert")
        log = jobs.run_job(spark, _params(base, "IL", day, day, vendors=(vendor,)), as_of=AS_OF)
        assert "from the changed days" in log.rows[-1][2]
        assert _weeks(spark, p) == _rebuilt(spark, p)
    assert not os.path.exists(p.week_state_path.rstrip("/") + "__open")


def test_states_of_a_killed_job_are_not_used(spark):
    """A job that fails between daily and weekly leaves its marker; the next one builds its weeks whole."""
    base = _setup(spark)
    p = _params(base, "FL", 19990101, 20001231)
    jobs.run_job(spark, p, as_of=AS_OF)
    il = _params(base, "IL", 19990106, 19990106, vendors=(1,))
    for units, fail, how in ((100.0, True, None), (50.0, False, "whole"), (25.0, False, "from the changed days")):
        sinks.write_partitioned(_fact(spark, [(1, 19990106, units)]), p.fact_path, S.DAILY_PARTITIONS, "upsert")
        if fail:
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(jobs, "_load_weekly", lambda *a: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    jobs.run_job(spark, il, as_of=AS_OF)
            assert os.path.exists(p.week_state_path.rstrip("/") + "__open")
            continue
        log = jobs.run_job(spark, il, as_of=AS_OF)
        assert ("from the changed days" in log.rows[-1][2]) == (how != "whole")
        assert _weeks(spark, p) == _rebuilt(spark, p)


def test_states_that_do_not_match_daily_are_not_used(spark):
    """Daily rows that the states never held: the weeks are built whole, and states are right afterwards."""
    base = _setup(spark)
    p = _params(base, "FL", 19990101, 20001231)
    jobs.run_job(spark, p, as_of=AS_OF)
    stray = read_daily(spark, p.daily_path, 19990106, 19990106, [1]).withColumn(S.STORE, F.lit(99))
    both = read_daily(spark, p.daily_path, 19990106, 19990106, [1]).union(stray.select(*S.DAILY_COLUMNS))
    sinks.write_daily(both, p.daily_path, "upsert")
    il = _params(base, "IL", 19990106, 19990106, vendors=(1,))
    assert "changed days" not in jobs.run_job(spark, il, as_of=AS_OF).rows[-1][2]
    assert _weeks(spark, p) == _rebuilt(spark, p)
    assert "changed days" in jobs.run_job(spark, il, as_of=AS_OF).rows[-1][2]


def test_a_full_load_makes_weekly_from_the_rows_it_writes(spark, monkeypatch):
    """The daily rows are at hand: their thousands of files are not opened again, and weekly equals a rebuild."""
    base = _setup(spark)
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "read_daily", lambda *a, **k: 1 / 0)
        p = _params(base, "FL", 19990101, 20001231)
        jobs.run_job(spark, p, as_of=AS_OF)
    assert _weeks(spark, p) == _rebuilt(spark, p)
