from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strataflux import schema
from strataflux.config import AnalysisConfig, QcConfig, RunConfig, parse_settings
from strataflux.operators import canonical, ledger, quality
from strataflux.sources import stats_files


def observation(spark, rows, fields):
    base = {"dataset": "d", "dataset_version": "1", "subject_id": "s", "session_id": "1", "region": "lh-x", "measure_type": "volume", "source_file": "f",
            "source_file_checksum": "c", "parser_version": "1", "ingested_at": "t", "hemisphere": "lh", "site": "A"}
    types = {f.name: f.dataType.simpleString() for f in schema.SCHEMA}
    full = [{**base, **dict(zip(fields, r))} for r in rows]
    columns = list(dict.fromkeys([*base, *fields]))
    return schema.conform(spark.createDataFrame([[x.get(c) for c in columns] for x in full], ", ".join(f"{c} {types[c]}" for c in columns)))


def test_conform_and_validate(spark):
    df = observation(spark, [("s1", 1.0), ("s2", 2.0)], ["subject_id", "value"]).withColumn("extra", F.lit(1))
    out = schema.conform(df)
    assert out.columns == [*schema.COLUMNS, "extra"] and dict(out.dtypes)["qc_flags"] == "array<string>"
    schema.validate(out)
    with pytest.raises(ValueError, match="repeated key"):
        schema.validate(out.unionByName(out))
    with pytest.raises(ValueError, match="nulls"):
        schema.validate(out.withColumn("region", F.lit(None).cast("string")))
    with pytest.raises(ValueError, match="absent"):
        schema.conform(out.drop("dataset"))
    assert schema.read_canonical(spark).count() == 0 and schema.empty(spark).columns == list(schema.COLUMNS)


def test_written_table_is_read_back(spark, tmp_path):
    df = observation(spark, [("s1", 1.0), ("s2", 2.0)], ["subject_id", "value"])
    schema.write_canonical(df, str(tmp_path / "a"))
    schema.write_canonical(df.withColumn("session_id", F.lit("2")), str(tmp_path / "b"))
    assert schema.read_canonical(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 4


def test_qc_ladder(spark):
    rows = [(f"s{i}", 100.0 + i % 5, 1.5e6, 10.0 + i % 3, 12.0) for i in range(20)]
    rows += [("out", 500.0, 1.5e6, 10.0, 12.0), ("bad", 101.0, 3e6, 10.0, 12.0), ("holes", 101.0, 1.5e6, 300.0, 12.0), ("unknown", None, None, None, None)]
    df = observation(spark, rows, ["subject_id", "value", "etiv", "surface_holes_lh", "surface_holes_rh"])
    got = {r.subject_id: r for r in quality.apply_qc(df).collect()}
    assert got["s1"].qc_status == "PASS" and got["s1"].qc_flags == [] and got["s1"].qc_notes == quality.CLEAN_NOTE and got["s1"].analysis_included
    assert got["out"].qc_flags == ["region_outlier"] and got["out"].qc_status == "WARNING" and got["out"].qc_score > 4
    assert got["bad"].qc_status == "FAIL" and not got["bad"].analysis_included
    assert got["holes"].qc_flags == ["euler_low"]
    assert got["unknown"].qc_status == "PASS" and got["unknown"].qc_score is None
    off = quality.apply_qc(df, QcConfig(enabled=False)).first()
    assert off.qc_status == "PASS" and off.qc_flags == [] and off.qc_notes == quality.DISABLED_NOTE
    wide = quality.apply_qc(df, analysis=AnalysisConfig(include_qc_status=("PASS", "WARNING")))
    assert wide.filter("subject_id = 'out'").first().analysis_included


def test_asymmetry_needs_both_sides(spark):
    rows = [(f"s{i}", f"{h}-x", h, 100.0 + (i % 4) * (1 if h == "lh" else 2)) for i in range(20) for h in ("lh", "rh")]
    rows += [("odd", "lh-x", "lh", 100.0), ("odd", "rh-x", "rh", 160.0), ("one", "lh-x", "lh", 100.0), ("zero", "lh-x", "lh", 5.0), ("zero", "rh-x", "rh", -5.0)]
    df = observation(spark, rows, ["subject_id", "region", "hemisphere", "value"])
    got = {r.subject_id: r for r in quality.asymmetry(df, QcConfig().thresholds).collect()}
    assert got["odd"].asymmetry_outlier and "one" not in got and got["zero"].asymmetry is None and not got["zero"].asymmetry_outlier


def test_confusion(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True), (None, False), (False, None)], "p boolean, t boolean")
    r = quality.confusion(df, "p", "t").first()
    assert (r.tp, r.fp, r.fn, r.tn) == (1, 1, 1, 2) and r.recall == 0.5 and abs(r.false_positive_rate - 1 / 3) < 1e-12


def test_ledger_classes_and_differences(spark):
    roster = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "2"), ("c", "1")], "subject_id string, session_id string")
    found = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("x", "9")], "subject_id string, session_id string")
    assert {r.subject_id: r["class"] for r in ledger.expected_and_found(roster, found).collect()} == {"a": "completer", "b": "partial", "c": "absent"}
    people = spark.createDataFrame([("completer", 1.0), ("completer", 3.0), ("partial", 2.0), ("partial", 6.0), ("partial", None)], "class string, x double")
    one = ledger.standardized_differences(ledger.continuous_summary(people, "class", ["x"])).first()
    assert abs(one.smd - (2 - 4) / ((2 + 8) / 2) ** 0.5) < 1e-12 and one.notable and one.n_b == 2
    counts = spark.createDataFrame([("m", "k", 1), ("m", "k", 2), ("m", "j", 5)], "metric string, key string, n bigint")
    assert {r.key: r.n for r in ledger.merge_counters(counts).collect()} == {"k": 3, "j": 5}


def test_value_counts_show_nulls_and_skip_absent_columns(spark):
    df = spark.createDataFrame([("x",), (None,), ("x",)], "a string")
    assert {(r.field, r.value): r.n for r in ledger.value_counts(df, ["a", "zz"]).collect()} == {("a", "x"): 2, ("a", "<null>"): 1}
    assert ledger.value_counts(df, ["zz"]).count() == 0


def test_funnel_reconciles_and_loses_something(spark, tiny):
    from strataflux.plans import reference
    from strataflux.sources.tables import table

    qc = reference._qc(spark, tiny)
    parts = (ledger.roster_of(table(spark, tiny, "sessions")), ledger.discovered_of(table(spark, tiny, "subject_sessions")))
    rows = ledger.funnel(*parts, qc, qc, table(spark, tiny, "region_set"))
    assert ledger.reconcile(rows, 28) == []
    assert rows.agg(F.sum("lost")).first()[0] > 0


def test_codes_and_sites(spark):
    df = spark.createDataFrame([("1.0", "UCLA_1_0051234"), ("9", "Site_12"), (None, None)], "c string, s string")
    got = df.select(canonical.decode(F.col("c"), {"1": "M", "2": "F"}), canonical.site_from_subject_id(F.col("s")), canonical.site_from_subject_id(F.col("s"), True)).collect()
    assert [tuple(r) for r in got] == [("M", "UCLA_1", "UCLA"), ("9", "Site", "Site"), (None, None, None)]


def test_wide_table_becomes_long(spark):
    wide = spark.createDataFrame([("s1", "1.5", "x"), ("s2", None, "2")], "`Measure:volume` string, `Left-Putamen` string, other string")
    names = spark.createDataFrame([("Left-Putamen", "lh-putamen")], "source_name string, region string")
    got = {r.subject_id: (r.region, r.value) for r in canonical.wide_to_long(wide, "Measure:volume", names, "volume", "mm^3").collect()}
    assert got == {"s1": ("lh-putamen", 1.5), "s2": ("lh-putamen", None)}


def test_files_of_a_folder_keep_empty_ones(spark, tmp_path):
    d = tmp_path / "sub" / "1" / "stats"
    d.mkdir(parents=True)
    (d / "aseg.stats").write_bytes(b"# cvs_version 6.0.0\n# note \xe9\n1 2 3 4 Left-Putamen 5 6 7 8 9\n")
    (d / "lh.aparc.stats").write_bytes(b"")
    files = {Path(r.source_file).name: r for r in stats_files.list_files(spark, str(tmp_path)).collect()}
    assert files["lh.aparc.stats"].size_bytes == 0 and "é" in files["aseg.stats"].content and len(files["aseg.stats"].source_file_checksum) == 64


def test_config_rejects_unknown_keys(tmp_path):
    good, bad = tmp_path / "good.yaml", tmp_path / "bad.yaml"
    good.write_text("qc: {enabled: false}\n")
    bad.write_text("qc: {enabeld: false}\n")
    assert not parse_settings(good.read_text()).qc.enabled and RunConfig().model_dump(mode="json")["harmonization"]["min_batch_size"] == 20
    with pytest.raises(ValueError):
        parse_settings(bad.read_text())


def test_core_does_not_need_the_llm_package():
    root = Path(schema.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "strataflux.llm" not in path.read_text(), path


def test_funnel_has_files_and_models(spark):
    files = lambda s: [f"file:/d/{s}/{n}" for n in ("aseg.stats", "lh.aparc.stats")]
    discovered = spark.createDataFrame([("p", s, files(s)) for s in "abc"], "subject_id string, session_id string, files array<string>")
    roster = discovered.select("subject_id", "session_id").withColumn("missing_cause", F.lit(None).cast("string"))
    failures = spark.createDataFrame([(files("a")[0], "EMPTY_FILE"), *[(f, "NO_DATA_ROWS") for f in files("b")]], "source_file string, failure_code string")
    regions = spark.createDataFrame([("lh-x", "lh", "thickness"), ("lh-y", "lh", "volume")], "region string, hemisphere string, measure_type string")
    # session c has files without a verdict but no region of the vocabulary
    qc = spark.createDataFrame([("p", "a", "lh-x", "thickness", "PASS", True)], "subject_id string, session_id string, region string, measure_type string, qc_status string, analysis_included boolean")
    fits = spark.createDataFrame([("lh-x", "thickness", False)], "region string, measure_type string, estimable boolean")
    modeled = spark.createDataFrame([], "n bigint")
    out = ledger.funnel(roster, discovered, qc, qc, regions, failures, modeled, ledger.model_exclusions(qc, fits, F.lit(True)))
    rows = {r.boundary: (r["count"], r.lost, r.causes) for r in out.collect()}
    assert rows["parsed files"] == (3, 3, "EMPTY_FILE=1; NO_DATA_ROWS=2")
    assert rows["sessions with observations"] == (1, 2, "all_files_rejected=1; no_recognised_regions=1")
    assert rows["canonical observations"] == (1, 1, "source_unavailable=1")
    assert rows["modeled observations"] == (0, 1, "design_not_identifiable=1")
    assert ledger.reconcile(out, 2, files=6, included=1) == [] and len(ledger.reconcile(out, 2, files=7, included=2)) == 2
