from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataflux.operators import rejects

RAW = "file_id bigint, source_file string, content string, cols string, line string, i int"
HEAD = "# ColHeaders StructName NumVert ThickAvg\n"


def cases(spark, contents, name="x/lh.aparc.stats"):
    rows = [(i, name if isinstance(c, (str, type(None))) else c[0], c if isinstance(c, (str, type(None))) else c[1], "a", "b", 1) for i, c in enumerate(contents)]
    lines = rejects.read_permissively(spark.createDataFrame(rows, RAW)).cache()
    bad = sorted((r.file_id, r.line_number, r.failure_code) for r in rejects.rejected(lines).collect())
    return bad, lines


def test_file_codes(spark):
    bad, _ = cases(spark, ["", None, " \n\t\r\n", "# Measure a, b, 1\nx 1 2\n", HEAD, HEAD + "\n# x\n", ("y/aseg.stats", "# nothing\n"), ("y/aseg.stats", "1 2 3 4 Left-X 5 6 7 8 9")])
    assert bad == [
        (0, 0, "EMPTY_FILE"), (1, 0, "EMPTY_FILE"), (2, 0, "EMPTY_FILE"), (3, 0, "NO_COLHEADERS"), (4, 0, "NO_DATA_ROWS"), (5, 0, "NO_DATA_ROWS"), (6, 0, "NO_DATA_ROWS"),
    ]


def test_row_codes_and_loaded_rest(spark):
    body = ['pre 1 2,5', '"two words" +1 1e-3', ' "x"\t2   .5 ', "bad 1", "bad 1 2 3", "bad x 2", 'bad" 1 2', '"bad 1 2', '"b"ad 1 2', '"" 1 2.', "# c", "", "bad 1.2.3 4"]
    bad, lines = cases(spark, [HEAD + "\r\n".join(body)])
    assert [(n, c) for _, n, c in bad] == [
        (5, "TRUNCATED_ROW"), (6, "COLUMN_COUNT_MISMATCH"), (7, "UNPARSEABLE_NUMERIC"), (8, "BROKEN_QUOTING"), (9, "BROKEN_QUOTING"), (10, "BROKEN_QUOTING"), (14, "UNPARSEABLE_NUMERIC"),
    ]
    got = {(r.line_number, r.column_name): (r.struct_name, r.value) for r in rejects.loaded_rows(lines).collect()}
    assert got[2, "ThickAvg"] == ("pre", 2.5) and got[3, "ThickAvg"] == ("two words", 0.001) and got[4, "NumVert"] == ("x", 2.0) and got[11, "ThickAvg"] == ("", 2.0)
    raw = {r.line_number: r._corrupt_record for r in rejects.rejected(lines).collect()}
    assert raw[8] == 'bad" 1 2'


def test_measure_codes(spark):
    head = ["# Measure a, b, c, 1.5, mm", '#Measure x, "q, r", 2', '#\tMeasure y, "q, 3', "# Measure , b, 1", "# Measure a, b, --", "# Measure", '# Measure "z", 1,5', "# Measures a"]
    bad, lines = cases(spark, ["\n".join(head) + "\n" + HEAD + "s 1 2"])
    assert [(n, c) for _, n, c in bad] == [(3, "BROKEN_QUOTING"), (4, "MALFORMED_MEASURE"), (5, "MALFORMED_MEASURE"), (6, "MALFORMED_MEASURE")]
    got = {r.measure: (r.value, r.unit) for r in rejects.loaded_measures(lines).collect()}
    assert got == {"a": (1.5, "mm"), "x": (2.0, "2"), "z": (5.0, "5")}


def test_empty_table_and_long_line(spark):
    bad, _ = cases(spark, [HEAD + "s " + "9" * 200_000 + " 2"])
    assert bad == []
    many = "s 1 2" + " 2.5" * 100_000
    measure = "# Measure a" + ", x" * 100_000 + ", 1"
    bad, lines = cases(spark, [measure + "\n" + HEAD + many + '\n' + many + ' "x'])
    assert bad == [(0, 3, "COLUMN_COUNT_MISMATCH"), (0, 4, "BROKEN_QUOTING")]
    assert [r.value for r in rejects.loaded_measures(lines).collect()] == [1.0]
    empty = rejects.read_permissively(spark.createDataFrame([], RAW))
    assert empty.count() == 0 and rejects.loaded_rows(empty).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='ab1 .,"#\t\r\n-eMeasureColHeaders', max_size=80), min_size=1, max_size=20))
def test_any_text_gives_a_verdict(spark, texts):
    bad, lines = cases(spark, [HEAD + t for t in texts])
    assert all(c for _, _, c in bad)
    assert lines.filter("kind <> 'file' AND failure_code IS NULL AND size(fields) = 0").count() == 0


def test_table_and_side_come_from_the_header_where_the_name_is_silent(spark):
    from strataflux.sources import stats_files

    rows = "# ColHeaders StructName ThickAvg\nentorhinal 2.5\n"
    files = [
        ("a", "/d/sub1_lh.aparc.stats", "# hemi lh\n" + rows), ("b", "/d/stats1.stats", "# cmdline mris_anatomical_stats -b sub1 rh white\n" + rows),
        ("c", "/d/stats2.stats", "# cmdline mri_segstats --seg aseg.mgz\n1 17 100 4000.5 Left-Hippocampus 80 8 40 120 80\n"),
        ("d", "/d/stats3.stats", rows), ("e", "/d/aparc.stats", rows), ("f", "/d/lh.aparc.stats", rows),
    ]
    raw = spark.createDataFrame(files, "file_id string, source_file string, content string")
    regions = spark.read.parquet("/root/testdata/sf0.001/region_set.parquet")
    got = {(r.file_id, r.region, r.value) for r in stats_files.canonical_rows(raw, regions).collect()}
    assert got == {("a", "lh-entorhinal", 2.5), ("b", "rh-entorhinal", 2.5), ("c", "lh-hippocampus", 4000.5), ("f", "lh-entorhinal", 2.5)}
    verdicts = stats_files.all_verdicts(raw, rejects.read_permissively(raw))
    assert {(r.file_id, r.failure_code) for r in verdicts.collect()} == {("d", "UNKNOWN_TABLE_TYPE"), ("e", "UNKNOWN_TABLE_TYPE")}
