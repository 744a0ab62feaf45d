from datetime import datetime

from strataflux.operators import drift, widen

CELLS = "subject_id string, session_id string, region string, measure_type string, value double, ingested_at string, signature string, cells int"


def test_widen_typed_columns_and_conflicts(spark):
    rows = [
        ("a", "1", "lh-x", "volume", 1.0, "t1"), ("a", "1", "lh-x", "volume", 1.0, "t0"), ("a", "1", "rh-x", "volume", 2.0, "t1"),
        ("b", "1", "lh-x", "volume", 3.0, "t1"), ("b", "1", "lh-x", "volume", 4.0, "t2"), ("b", "1", "lh-x", "area", None, "t1"),
        ("c", "1", "lh-x", "volume", float("nan"), "t3"), ("c", "1", "lh-x", "volume", 5.0, "t1"), (None, None, None, None, 7.0, None),
        ("d", "2", "lh-x", "volume", 1.0, None), ("d", "2", "lh-x", "volume", float("inf"), None),
    ]
    for classes in (1, 2, 16):
        wide = widen.widen(spark.createDataFrame([(*r, "s", 1) for r in rows], CELLS), classes=classes)
        got = {(r.subject_id, r.session_id): r for r in wide.collect()}
        assert len(got) == 5
        assert got["a", "1"].lh_x__volume == 1.0 and got["a", "1"].rh_x__volume == 2.0 and got["a", "1"].n_attributes == 2
        assert got["b", "1"].lh_x__volume == 4.0 and got["b", "1"].lh_x__area is None and got["b", "1"].n_attributes == 2
        assert got["c", "1"].lh_x__volume == 5.0 and got[None, None].unknown__unknown == 7.0
        assert dict(wide.dtypes)["lh_x__volume"] == "double"
        bad = {(r.subject_id, r.region, r.measure_type) for r in widen.conflicting_cells(wide).collect()}
        assert bad == {("b", "lh-x", "volume"), ("d", "lh-x", "volume")}


def test_widen_keeps_clashing_names_apart(spark):
    regions = ["a.b", "a-b", "A-b", None, "unknown", ""]
    rows = [("s", "1", r, "volume", float(i), "t", "s", 1) for i, r in enumerate(regions)]
    for classes in (1, 2):
        wide = widen.widen(spark.createDataFrame(rows, CELLS), classes=classes)
        got = wide.collect()[0].asDict()
        names = ["a_b__volume_3", "a_b__volume_2", "A_b__volume", "unknown__volume", "unknown__volume_2", "__volume"]
        assert [got[n] for n in names] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
        assert got["n_attributes"] == 6 and got["conflicts"] == []


def test_widen_nothing(spark):
    wide = widen.widen(spark.createDataFrame([], CELLS))
    assert wide.count() == 0 and widen.conflicting_cells(wide).count() == 0


FILES = (
    "file_id bigint, stream_id bigint, seq int, source_file string, col_headers array<string>, header_measures map<string,string>, "
    "data_rows array<array<string>>, received_at timestamp_ntz, bucket string, columns string"
)


def file(i, seq, cols, rows, measures=None, stream=1):
    return (i, stream, seq, "f", cols, measures or {}, rows, datetime(2020, 1, 1), "x", "y")


def changes(spark, rows):
    return sorted(tuple(r) for r in drift.schema_changes(spark.createDataFrame(rows, FILES)).collect())


def test_changes_between_files(spark):
    rows = [
        file(10, 1, ["A", "B", "C"], [["1", "2.5", "x"]], {"m": "1", "k": "2.0"}),
        file(11, 2, ["A", "B2", "C"], [["1", "2.5", "x"]], {"m": "1", "q": "x"}),  # renamed in place; the only measure that left and came
        file(11, 2, ["A", "B2", "C"], [["1", "2.5", "x"]], {"m": "1", "q": "x"}),  # sent twice
        file(12, 3, ["C", "A", "B2"], [["x", "1", "2.5"]], {"q": "x", "m": "1.0"}),  # order alone; a measure's type
        file(13, 4, ["C", "A", "D"], [["x", "1", "text"]], {"q": "x", "m": "1.0"}),  # other type: no renaming
        file(14, 5, ["C", "a", "D"], [["x", None, "text"], ["x", "2", ""]], {"q": "x", "m": "1.0", "r": "1", "s": "1"}),
        file(20, 9, ["A"], [], None, stream=2), file(21, 10, ["A", "E"], None, None, stream=2), file(30, 1, None, None, None, stream=None),
    ]
    assert changes(spark, rows) == [
        (11, "column", "renamed", "B", "B2"), (11, "measure", "renamed", "k", "q"), (12, "measure", "type_changed", "m", ""),
        (13, "column", "added", "D", ""), (13, "column", "removed", "B2", ""), (14, "column", "renamed", "A", "a"),
        (14, "measure", "added", "r", ""), (14, "measure", "added", "s", ""), (21, "column", "added", "E", ""),
    ]
    assert changes(spark, []) == []


def test_consistent_table_splits_types(spark):
    rows = [file(1, 1, ["A", "B"], [["1", "2.5 mm^3"], ["1.5", None, "over"]], {"m": "<3>"})]
    got = {(r.part_of, r.row_no, r.field): r for r in drift.consistent_table(spark.createDataFrame(rows, FILES)).collect()}
    assert got["column", 1, "A"].as_int == 1 and got["column", 2, "A"].as_decimal == 1.5
    assert got["column", 1, "B"].as_text == "2.5 mm^3" and got["column", 1, "B"].number == 2.5
    assert got["column", 2, "B"].type_tag is None and got["column", 2, "#2"].as_text == "over"
    assert got["measure", 0, "m"].number == 3.0
    fused = {(r.part_of, r.field): r.alternatives for r in drift.fused_schema(spark.createDataFrame(rows, FILES)).collect()}
    assert fused["column", "A"] == "decimal" and fused["measure", "m"] == "text"


def test_long_streams_cross_buckets(spark):
    rows = [file(i, i, [f"c{i}"], [["1"]]) for i in range(250, 262)]
    assert [c[0] for c in changes(spark, rows)] == list(range(251, 262))
