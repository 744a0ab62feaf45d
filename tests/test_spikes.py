from datetime import datetime, timedelta

import pytest

from strataflux.operators import spikes

SCHEMA = (
    "site string, subject_id string, session_id string, dataset_version string, acquired_at timestamp_ntz, region string, hemisphere string, "
    "measure_type string, value double, etiv double, surface_holes_lh double, bucket string, sid string"
)
REGIONS = "region string, structure string, hemisphere string, measure_type string, unit string, source_names array<string>"
VOCABULARY = [("lh-putamen", "putamen", "lh", "volume", "mm^3", ["Left-Putamen"]), ("rh-putamen", "putamen", "rh", "volume", "mm^3", None)]


def rows_of(values, site="S", region="lh-putamen", load="r1", etiv=None, holes=None, measure="volume", start=0):
    t = datetime(2020, 1, 28)
    return [
        (site, f"p{start + i}", "1", load, t + timedelta(days=i), region, "lh", measure, v, etiv[i] if etiv else None, holes[i] if holes else None, "x", "y")
        for i, v in enumerate(values)
    ]


def found(spark, rows):
    readings = spikes.readings_of(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(VOCABULARY, REGIONS))
    flags, shifts = spikes.implausible_readings(readings)
    return {(r.field, r.subject_id, r.region, r.kind) for r in flags.filter("beyond").collect()}, shifts.collect()


def test_limits_spikes_and_nulls(spark):
    base = [100.0 + (i * 7) % 13 for i in range(60)]
    values = [*base, float("nan"), float("inf"), -1.0, 0.0, 500.0, None]
    holes = [10.0 + i % 5 for i in range(62)] + [-1.0, 2.5, 10.0, None]
    rows = rows_of(values, holes=holes)
    rows += [(None, *r[1:]) for r in rows_of([9e9], start=900)] + rows_of([1.0], measure="area", start=950)
    got, _ = found(spark, rows)
    kinds = lambda kind, field: {s for f, s, _, k in got if k == kind and f == field}
    assert kinds("limit", "value") == {"p60", "p61", "p62", "p63"}
    assert kinds("spike", "value") == {"p62", "p63", "p64"}
    assert kinds("limit", "surface_holes_lh") == {"p62", "p63"}


def test_stuck_runs_need_five_and_cross_buckets(spark):
    value = lambda i: 100.0 + i * 0.37
    values = [value(i) for i in range(20)]
    values[2:7] = [55.0] * 5  # over the end of January
    values[10:14] = [66.0] * 4
    values[15:17] = [77.0, None]
    values[17:20] = [77.0] * 3  # a session without the reading is skipped: still four
    got, _ = found(spark, rows_of(values))
    assert {s for _, s, _, k in got if k == "stuck"} == {f"p{i}" for i in range(2, 7)}


def test_stuck_runs_end_with_the_load_and_ignore_repeats(spark):
    rows = rows_of([9.0] * 3, load="r1") + rows_of([9.0] * 3, load="r2", start=3)
    rows += rows  # everything sent twice
    got, _ = found(spark, rows)
    assert not {g for g in got if g[3] == "stuck"}


def test_names_are_canonical(spark):
    rows = [r[:5] + (name, *r[6:]) for r, name in zip(rows_of([1.0, 2.0, 3.0, -5.0]), ("LH_putamen ", "Left-Putamen", "putamen", " lh-Putamen"))]
    got, _ = found(spark, rows)
    assert {(s, region) for _, s, region, k in got if k == "limit"} == {("p3", "lh-putamen")}


def test_constant_source_flags_every_other_reading(spark):
    got, _ = found(spark, rows_of([5.0, 5.0, 6.0, 5.0, 5.0]))
    assert {(s, k) for _, s, _, k in got} == {("p2", "spike")}


def test_level_shift_is_reported(spark):
    values = [100.0 + (i * 7) % 5 for i in range(31)] + [104.0 + (i * 7) % 5 for i in range(28)] + [100.0 + (i * 7) % 5 for i in range(60)]
    _, shifts = found(spark, rows_of(values))
    assert shifts and all(r.score > 6 for r in shifts)


def test_empty(spark):
    got, shifts = found(spark, [])
    assert not got and not shifts


def test_threshold_may_not_lose_cases():
    with pytest.raises(ValueError):
        spikes.SpikeRules(innovation=7.0)


def sparse(values, days):
    """One reading every `days` days, so that no month holds five of them."""
    t = datetime(2020, 1, 28)
    return [(*r[:4], t + timedelta(days=i * days), *r[5:]) for i, r in enumerate(rows_of(values))]


def test_level_shift_between_thin_months_and_inside_one(spark):
    step = lambda n: [100.0 + (i * 7) % 5 for i in range(n)] + [106.0 + (i * 7) % 5 for i in range(n)]
    up_and_down = [100.0 + (i * 7) % 5 + [0, 8, 4][i // 40] for i in range(120)]
    # in site T all but eight readings lie in February
    _, shifts = found(spark, sparse(step(40), 10) + [("T", *r[1:]) for r in sparse(step(28), 0.5)] + [("U", *r[1:]) for r in sparse(up_and_down, 10)])
    day = lambda n: (datetime(2020, 1, 28) + timedelta(days=n)).date()
    assert sorted((r.site, r.since) for r in shifts) == [("S", day(400)), ("T", day(14)), ("U", day(400)), ("U", day(800))]


def test_predecessor_is_taken_across_months(spark):
    values = [100.0 + (i * 7) % 13 for i in range(60)]
    values[40] = 500.0
    rows = sparse(values, 31)  # one reading a month
    readings = spikes.readings_of(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(VOCABULARY, REGIONS))
    flag = [r for r in spikes.implausible_readings(readings)[0].collect() if r.kind == "spike"]
    med, mad = 106.0, 3.0
    assert len(flag) == 1 and abs(flag[0].score - (500 - med) / (1.4826 * mad)) > 1e-6


def test_level_and_residual_decide_what_a_reading_is(spark):
    base = [100.0 + (i * 7) % 13 for i in range(200)]
    values = [x + (140 if i >= 140 else 0) for i, x in enumerate(base)]
    values[170] = 106.0  # the source's median, within a level that lies far from it
    values[60] = 240.0  # the shifted level's value, alone
    readings = spikes.readings_of(spark.createDataFrame(rows_of(values), SCHEMA), spark.createDataFrame(VOCABULARY, REGIONS))
    flags, shifts = spikes.implausible_readings(readings)
    got = {(r.subject_id, r.kind): r.beyond for r in flags.collect()}
    assert got[("p170", "spike")] is False and got[("p60", "spike")] is True
    assert all(got[(f"p{i}", "shift")] for i in range(145, 195) if i != 170)
    assert not [k for k in got if k[0] in {f"p{i}" for i in range(130) if i != 60}]
    assert [(r.since, r.level_before < 1, r.level > 8) for r in shifts.collect()] == [((datetime(2020, 1, 28) + timedelta(days=140)).date(), True, True)]
    one, _ = spikes.implausible_readings(readings, spikes.SpikeRules(shift=1e9))  # without level shifts
    assert ("p170", "spike") not in {(r.subject_id, r.kind) for r in one.collect()}
