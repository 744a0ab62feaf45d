import shutil

import pytest
import yaml
from synth import write_files

from strataflux import cli
from strataflux.plans import pipeline
from strataflux.sources.adapters import FlatAdapter, build_adapter
from strataflux.streaming import counters


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    write_files(root)
    return root


def test_run_from_files_to_report(spark, dataset, tiny, tmp_path):
    config = tmp_path / "run.yaml"
    config.write_text(yaml.safe_dump({"dataset": {"root": str(dataset), "name": "demo"}, "harmonization": {"min_batch_size": 5}}))
    out = tmp_path / "out"
    assert cli.main(["run", "--config", str(config), "--outdir", str(out), "--regions", f"{tiny}/region_set.parquet"]) == 0
    rows = {r.boundary: r for r in pipeline.load(spark, str(out), "accounting_funnel").collect()}
    assert rows["expected sessions"]["count"] == 72 and rows["discovered sessions"].causes == "missing_acquisition=1"
    assert rows["sessions with observations"].causes == "missing_derivative=1"
    # one truncated and one empty subcortical file: their regions have no source, the cortical ones are still there
    assert rows["canonical observations"]["count"] == 70 * 28 - 2 * 14 and rows["canonical observations"].causes == "source_unavailable=28"
    failures = {r.failure_code for r in pipeline.load(spark, str(out), "parse_failures").collect()}
    assert failures == {"EMPTY_FILE", "TRUNCATED_ROW"}
    html = (out / "report.html").read_text()
    assert "Loss funnel" in html and html.count("<svg") >= 6 and "does not reconcile" not in html
    results = pipeline.load(spark, str(out), "model_results").toPandas()
    assert len(results) == 28 and results.converged.mean() > 0.8
    shifted = pipeline.load(spark, str(out), "harmonized_observations").filter("region = 'lh-precuneus'").groupBy("site").avg("value", "value_original").toPandas()
    gap = lambda c: abs(shifted[c].iloc[0] - shifted[c].iloc[1])
    assert gap("avg(value)") < gap("avg(value_original)")


def test_one_subject_and_collect(spark, dataset, tiny, tmp_path):
    from strataflux.config import RunConfig

    regions = spark.read.parquet(f"{tiny}/region_set.parquet")
    config = RunConfig.model_validate({"dataset": {"root": str(dataset)}})
    parts = [str(tmp_path / s) for s in ("sub-000", "sub-001")]
    for p in parts:
        pipeline.ingest(spark, config, regions, p, subject=p[-7:])
    pipeline.collect(spark, parts, str(tmp_path / "all"))
    assert pipeline.load(spark, str(tmp_path / "all"), "observations").count() == 2 * 3 * 28
    counted = {(r.metric, r.key): r.n for r in pipeline.load(spark, str(tmp_path / "all"), "ingest_counters").collect()}
    assert counted["files", "discovered"] == 18 and counted["observations", "volume"] == 84


def test_bad_configuration_is_exit_2(tmp_path, capsys):
    bad = tmp_path / "bad.yaml"
    bad.write_text("nonsense: 1\n")
    assert cli.main(["qc", "--config", str(bad), "--outdir", str(tmp_path)]) == 2
    assert "nonsense" in capsys.readouterr().err
    assert cli.main(["version"]) == 0


def test_flat_layout_with_phenotype(spark, tmp_path):
    for name in ("UCLA_1_0051201", "NYU_0050002", "SDSU_77"):
        d = tmp_path / "fs" / name / "stats"
        d.mkdir(parents=True)
        for f in ("aseg.stats", "lh.aparc.stats", "lh.aparc.a2009s.stats"):
            (d / f).write_text("x")
    (tmp_path / "p.csv").write_text("sub_id,SITE_ID,AGE_AT_SCAN,Sex,DX_GROUP\n51201,UCLA,12.5,1,2\n50002.0,NYU,x,2,1\n999,GONE,9,1,1\n51201,UCLA,12.5,1,2\n")
    a = FlatAdapter(spark, str(tmp_path / "fs"), phenotype=str(tmp_path / "p.csv"))
    found = a.discover()
    assert {len(r.files) for r in found.collect()} == {2}
    meta = {r.subject_id: r for r in a.metadata(found).collect()}
    assert (meta["UCLA_1_0051201"].site, meta["UCLA_1_0051201"].sex, meta["UCLA_1_0051201"].dx_baseline) == ("UCLA", "M", "control")
    assert meta["NYU_0050002"].age_baseline is None and meta["NYU_0050002"].dx_baseline == "patient" and meta["SDSU_77"].site == "SDSU"
    roster = {r.subject_id: r.missing_cause for r in a.roster().collect()}
    assert roster["999"] == "missing_acquisition" and len(roster) == 4
    assert FlatAdapter(spark, str(tmp_path / "fs")).metadata(found).count() == 3
    with pytest.raises(ValueError):
        build_adapter(spark, "other", "x")


def test_stream_counters_equal_the_batch(spark, tiny, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    shutil.copy(f"{tiny}/observations.parquet", folder / "a.parquet")
    stream = counters.arriving(spark, str(folder))
    counters.run_counters(stream, str(tmp_path / "arrived"), str(tmp_path / "c1")).awaitTermination()
    got = {(r.start, r.site, r.measure_type): (r.n, r.n_null) for r in counters.latest_counters(spark, str(tmp_path / "arrived")).collect()}
    batch = counters.window_counts(spark.read.parquet(f"{tiny}/observations.parquet"))
    assert got == {(r.start, r.site, r.measure_type): (r.n, r.n_null) for r in batch.collect()} and len(got) > 3


def test_discovered_and_read_files_have_one_name(spark, tmp_path):
    from strataflux.sources import stats_files

    for folder in ("derivatives/freesurfer/s1/v1/stats", "elsewhere"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "aseg.stats").write_text("x")
    (tmp_path / "elsewhere" / "lh.aparc.stats").write_text("")
    listed = stats_files.list_files(spark, str(tmp_path))
    owned = build_adapter(spark, "nested", str(tmp_path)).discover().selectExpr("explode(files) AS source_file")
    assert listed.join(owned, "source_file").count() == 1
    gone = spark.createDataFrame([("s3a://bucket/s2/aseg.stats",)], "source_file string")
    lost = pipeline.unmatched_files(listed, owned.unionByName(gone), whole=True)
    assert sorted((r.source_file.rpartition("/")[2], r.failure_code) for r in lost.collect()) == [
        ("aseg.stats", "NOT_READ"), ("aseg.stats", "UNCLAIMED_FILE"), ("lh.aparc.stats", "UNCLAIMED_FILE")
    ]
    assert not pipeline.unmatched_files(listed, owned, whole=False).count()


def test_report_leaves_no_row_out(spark, monkeypatch):
    from strataflux.plans import report

    assert len(report._rows(spark.range(2_500))) == 2_500
    monkeypatch.setattr(report, "SUMMARY_ROWS", 10)
    assert len(report._rows(spark.range(10))) == 10
    with pytest.raises(ValueError, match="more than 10 rows"):
        report._rows(spark.range(11))


def test_ten_thousand_session_folders_are_walked_in_tasks(spark, tmp_path):
    for i in range(2_000):
        for v in range(5):
            (tmp_path / f"derivatives/freesurfer/s{i}/v{v}/stats").mkdir(parents=True)
        (tmp_path / f"derivatives/freesurfer/s{i}/v0/stats/aseg.stats").write_text("x")
    (tmp_path / "derivatives/freesurfer/s7/v1/stats/notes.txt").write_text("x")
    found = build_adapter(spark, "nested", str(tmp_path)).discover()
    assert found.count() == 10_000 and found.filter("size(files) = 1").count() == 2_000
    one = build_adapter(spark, "nested", str(tmp_path), "s7").discover().collect()
    assert sorted((r.session_id, len(r.files)) for r in one) == [("v0", 1), ("v1", 0), ("v2", 0), ("v3", 0), ("v4", 0)]


def test_versions_aliases_and_overwritten_measures(spark):
    from strataflux.operators import rejects
    from strataflux.sources import stats_files

    head = "# ColHeaders Index SegId NVoxels Volume_mm3 StructName normMean normStdDev normMin normMax normRange\n1 2 3 4 Left-X 5 6 7 8 9\n"
    texts = [
        "# cvs_version $Id: mri_segstats.c,v 1.75.2.2 2013/04/12 $\n# Measure IntraCranialVol, ICV, Intracranial Volume, 1549336.5, mm^3\n",
        "# generating_program_version 9\n# cvs_version 6.0.0\n# Measure Foo, lhSurfaceHoles, d, 12, unitless\n# Measure lhSurfaceHoles, 13, unitless\n",
        "# annotationfileversion v7\n# cvs_version 6.0.0\n# Measure Cortex, Number of Vertices, 1, unitless\n# Measure Cortex, Area, 2, mm\n# Measure Cortex, 3, mm\n",
    ]
    raw = spark.createDataFrame([(i, "aseg.stats", t + head) for i, t in enumerate(texts)], "file_id bigint, source_file string, content string")
    got = {r.file_id: r for r in stats_files.session_globals(raw, rejects.read_permissively(raw)).collect()}
    assert got[0].freesurfer_version is None and got[0].version_declaration.startswith("$Id: mri_segstats.c") and got[0].etiv == 1549336.5
    assert got[1].freesurfer_version == "6.0.0" and got[1].surface_holes_lh == 13.0 and got[1].measures_overwritten == 1
    assert got[2].freesurfer_version is None and got[2].version_declaration == "v7" and got[2].measures_overwritten == 1


def test_site_of_a_subject_id(spark):
    from pyspark.sql import functions as F

    from strataflux.operators.canonical import site_from_subject_id

    ids = ["NYU_0051", "CMU_a_0050642", "UM_1_0050272", "nonumber", "0051", "_12", "A_b_c_1", None]
    rows = spark.createDataFrame([(x,) for x in ids], "s string").select("s", site_from_subject_id(F.col("s")).alias("a"), site_from_subject_id(F.col("s"), True).alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [("NYU", "NYU"), ("CMU_a", "CMU"), ("UM_1", "UM"), (None, None), (None, None), (None, None), ("A_b_c", "A_b"), (None, None)]
