from datetime import datetime

from strataflux.operators import orphans, profile

ACCEPTED = (
    "column_name string, null_share double, n_distinct bigint, min_value double, max_value double, median_value double, iqr_value double, "
    "value_pattern string, top_value string, top_share double, rows bigint, num double"
)


def accepted(spark):
    return spark.createDataFrame(
        [("x", 0.1, 3, 0.0, 10.0, 5.0, 2.0, None, None, None, 1, 1.0), ("s", 0.0, 2, None, None, None, None, "[a-z]+", "aa", 0.5, 1, 1.0)], ACCEPTED
    )


def test_departures(spark):
    rows = [("fine", float(v), t) for v, t in zip((4, 5, 6, 5, 5, 4, 6, 5, 5), "aa bb aa bb aa bb aa bb aa".split())] + [("fine", None, "bb")]
    rows += [("odd", v, t) for v, t in zip((1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, float("nan"), 99.0, 8.0), ("A1", "A2", "A3", "A4", "A5", None, None, None, "a6", "a7"))]
    rows += [("null", None, None)] * 3 + [(None, 5.0, "aa")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "v string, x double, s string, load string")
    got = profile.profile(df, "v", ["x"], ["s"], accepted(spark))
    found = sorted((str(r.load), r.column_name, r.finding) for r in profile.departures(got, accepted(spark)).collect())
    assert found == [
        ("None", "s", "shift"), ("None", "x", "null_rate"), ("null", "s", "null_rate"), ("null", "x", "null_rate"), ("odd", "s", "distinct"),
        ("odd", "s", "null_rate"), ("odd", "s", "pattern"), ("odd", "s", "shift"), ("odd", "x", "distinct"), ("odd", "x", "null_rate"), ("odd", "x", "range"),
    ]
    one = {r.load: r for r in got.filter("column_name = 'x'").collect()}
    assert one["odd"].median == 5.0 and one["odd"].n_distinct == 10 and one["null"].median is None and one["null"].n_null == 3


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], "v string, x double, s string")
    got = profile.profile(df, "v", ["x"], ["s"], accepted(spark))
    assert got.count() == 0 and profile.departures(got, accepted(spark)).count() == 0


def test_expressions_describe_all_values_briefly(spark):
    values = [f"{i}.{j}" for i in range(10, 60) for j in range(10, 40)] + ["n/a"] * 5
    long = profile.long_values(spark.createDataFrame([("l", v) for v in values], "v string, s string"), "v", [], ["s"])
    chosen = profile.induced_expressions(profile.value_counts(long))
    report = {r.expression: r for r in profile.expression_report(chosen, accepted(spark)).collect()}
    assert report[r"\d\d\.\d\d"].n_rows == 1500 and report["n/a"].n_rows == 5 and len(report) == 2


def test_coverage_between_loads(spark):
    rows = [("l1", f"v{i}") for i in range(10)] + [("l2", f"v{i}") for i in range(5)] + [("l2", "other thing")] * 5
    long = profile.long_values(spark.createDataFrame(rows, "v string, s string"), "v", [], ["s"])
    got = profile.coverage_between_loads(profile.induced_expressions(profile.value_counts(long))).collect()
    assert [(r.load, r.previous_load, r.coverage) for r in got] == [("l2", "l1", 0.5)]


def test_orphans(spark):
    d = lambda day: datetime(2020, 1, day)
    subjects = spark.createDataFrame([("P1", d(1), None), ("P1", d(1), None), ("P2", d(9), None), ("P3", d(1), d(5)), ("P4", None, None)], "subject_id string, registered_at timestamp_ntz, withdrawn_at timestamp_ntz")
    sessions = spark.createDataFrame([("P1", "S1", d(1), None), ("P3", "S1", d(1), None)], "subject_id string, session_id string, registered_at timestamp_ntz, withdrawn_at timestamp_ntz")
    manifest = spark.createDataFrame([("f1", d(1), None), ("f2", d(6), None)], "source_file string, received_at timestamp_ntz, withdrawn_at timestamp_ntz")
    found = spark.createDataFrame(
        [
            (1, " p1 ", "s1", ["F1", "f1", None, "f9"], d(5), "x"), (2, "p2", "S1", None, d(5), "x"), (3, "P3", "s1 ", [], d(5), "x"), (4, None, "s1", ["f2"], d(5), "x"),
            (5, "p4", "s1", ["f2"], d(7), "x"), (6, "P3", "S1", [], d(4), "x"), (7, "P2", None, [], None, "x"),
        ],
        "discovery_id bigint, subject_id string, session_id string, stats_files array<string>, discovered_at timestamp_ntz, ref_id string",
    )
    parents = orphans.parent_keys(subjects, sessions, manifest)
    got = orphans.orphan_references(orphans.child_keys(found), parents)
    assert sorted((r.discovery_id, r.ref_table, r.ref_key, r.state) for r in got.collect()) == [
        (1, "file_manifest", "f9", "missing"), (2, "sessions", "s1", "missing"), (2, "subjects", "p2", "late"), (3, "subjects", "p3", "deleted"),
        (4, "file_manifest", "f2", "late"), (5, "sessions", "s1", "missing"),
    ]
    report = {(r.ref_table, r.period, r.state): r.n_references for r in orphans.orphan_report(got).collect()}
    assert report["subjects", "2020-01", "late"] == 1
    nothing = orphans.orphan_references(orphans.child_keys(found.limit(0)), parents.limit(0))
    assert nothing.count() == 0
