"""Schemas that drift between the files of a stream.

Tagged-union inference: each file's schema is a set of (part, field) paths with a type tag; the schemas
of all files are fused into one path -> alternatives table, a path with several alternatives is split
into typed branches (`as_int`, `as_decimal`, `as_text`) plus one canonical number, and what appears,
disappears or turns into another alternative from one file to the next is reported as a change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.operators.scaling import previous_in_group
from strataflux.session import materialize

INT, DECIMAL = r"^[0-9]+$", r"^([0-9]+\.[0-9]*|\.[0-9]+)$"
#: files per window task of one stream
FILES_PER_BUCKET = 256


def type_tag(cell: Column) -> Column:
    """0 = int (digits only), 1 = decimal (digits with a point), 2 = text; null for a null cell."""
    return F.when(cell.rlike(INT), 0).when(cell.rlike(DECIMAL), 1).when(cell.isNotNull(), 2)


def tag_name(tag: Column) -> Column:
    return F.when(tag == 2, "text").when(tag == 1, "decimal").otherwise("int")


def _one_of_each(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per file_id: rows with the same file_id are one file, the earliest received is kept."""
    kept = rows.groupBy("file_id").agg(F.min_by(F.struct(*columns), F.struct("received_at", "seq", "headers")).alias("f"))
    return kept.select("file_id", "f.*")


def distinct_files(parsed: DataFrame) -> DataFrame:
    """Whole files, each once."""
    entries = F.map_entries("header_measures").alias("m")
    rows = parsed.select("file_id", "received_at", "stream_id", "seq", F.xxhash64("col_headers").alias("headers"), "col_headers", entries, "data_rows")
    kept = _one_of_each(rows, ["stream_id", "seq", "col_headers", "m", "data_rows"])
    return kept.select("file_id", "stream_id", "seq", "col_headers", F.map_from_entries("m").alias("header_measures"), "data_rows")


def file_schemas(parsed: DataFrame) -> DataFrame:
    """(file_id, stream_id, seq, columns, measures), each file once; both arrays of struct<field, place, tags>, the tagged
    union of the path in this file.

    `tags` are the alternatives of its cells in order, int alone where it has none; tags are taken before rows travel.
    """
    none = F.array().cast("array<array<string>>")
    rows = F.coalesce("data_rows", none)
    headers = F.coalesce("col_headers", F.array().cast("array<string>"))
    integer = F.array(F.lit(0))

    def union(tags: Column) -> Column:
        found = F.array_sort(F.array_distinct(F.array_compact(tags)))
        return F.when(F.size(found) > 0, found).otherwise(integer)

    def column(name: Column, place: Column) -> Column:
        return F.struct(name.alias("field"), place.alias("place"), union(F.transform(rows, lambda r: type_tag(F.get(r, place)))).alias("tags"))

    entries = F.coalesce(F.map_entries("header_measures"), F.array().cast("array<struct<key:string,value:string>>"))
    measures = F.transform(entries, lambda e: F.struct(e["key"].alias("field"), F.lit(-1).alias("place"), union(F.array(type_tag(e["value"]))).alias("tags")))
    tagged = parsed.select(
        "file_id", "received_at", "stream_id", "seq", F.xxhash64("col_headers").alias("headers"), F.transform(headers, column).alias("columns"), measures.alias("measures")
    )
    return _one_of_each(tagged, ["stream_id", "seq", "columns", "measures"])


def widest(union: Column) -> Column:
    """The type of a path in a file: the widest of its alternatives."""
    return F.array_max(union)


def _changes(new: Column, old: Column, part: str) -> Column:
    """Array of struct<part_of, change, field, new_field> between two schemas of one file pair."""

    def names(schema: Column) -> Column:
        return F.transform(schema, lambda x: x["field"])

    gone = F.filter(old, lambda x: ~F.array_contains(names(new), x["field"]))
    come = F.filter(new, lambda x: ~F.array_contains(names(old), x["field"]))
    if part == "column":

        def partner(x: Column, others: Column) -> Column:
            return F.filter(others, lambda y: (y["place"] == x["place"]) & (widest(y["tags"]) == widest(x["tags"])))

    else:
        single = (F.size(gone) == 1) & (F.size(come) == 1)

        def partner(x: Column, others: Column) -> Column:
            return F.filter(others, lambda y: single)

    def entry(change: str, field: Column, new_field: Column) -> Column:
        return F.struct(
            F.lit(part).alias("part_of"), F.lit(change).alias("change"), field.alias("field"), new_field.alias("new_field")
        )

    blank = F.lit("")
    left = F.transform(
        gone,
        lambda x: F.when(F.size(partner(x, come)) > 0, entry("renamed", x["field"], F.get(partner(x, come), F.lit(0))["field"])).otherwise(
            entry("removed", x["field"], blank)
        ),
    )
    added = F.transform(F.filter(come, lambda x: F.size(partner(x, gone)) == 0), lambda x: entry("added", x["field"], blank))
    retyped = F.transform(
        F.filter(new, lambda x: F.exists(old, lambda y: (y["field"] == x["field"]) & (widest(y["tags"]) != widest(x["tags"])))),
        lambda x: entry("type_changed", x["field"], blank),
    )
    return F.concat(left, added, retyped)


def schema_changes(parsed: DataFrame) -> DataFrame:
    """(file_id, part_of, change, field, new_field): what differs from the file before it in its stream.

    The first file of a stream has no changes. Files are ordered by seq, then file_id. Null headers or
    measures count as none, null cells say nothing about a type, empty cells are text. Files without a
    stream_id form a stream of their own. An empty input gives an empty result; extra columns are ignored.
    """
    schemas = materialize(
        file_schemas(parsed).withColumn(
            "bucket", F.coalesce(F.floor(F.col("seq") / FILES_PER_BUCKET), F.lit(-1))
        ),
        "schemas",
    )
    paired = previous_in_group(schemas, ["stream_id"], "bucket", ["seq", "file_id"], ["columns", "measures"]).filter(
        F.col("prev_columns").isNotNull()
    )
    changes = F.concat(
        _changes(F.col("columns"), F.col("prev_columns"), "column"), _changes(F.col("measures"), F.col("prev_measures"), "measure")
    )
    return paired.select("file_id", F.explode(changes).alias("c")).select("file_id", "c.*")


def fused_schema(parsed: DataFrame) -> DataFrame:
    """(part_of, field, alternatives, branches, n_files, first_file): the fused schema of all files, one row per path.

    `alternatives` are the types that the path has in files, `branches` those of its cells, which the consistent table
    parts.
    """
    path = lambda part: F.transform(f"{part}s", lambda x: F.struct(F.lit(part).alias("part_of"), x["field"].alias("field"), x["tags"].alias("tags")))
    paths = file_schemas(parsed).select("file_id", F.explode(F.concat(path("column"), path("measure"))).alias("p")).select("file_id", "p.*")
    listed = lambda holds: F.array_join(F.array_compact(F.array(*[F.when(F.max(holds(tag)), F.lit(name)) for tag, name in ((1, "decimal"), (0, "int"), (2, "text"))])), "|")
    return paths.groupBy("part_of", "field").agg(
        listed(lambda tag: widest(F.col("tags")) == tag).alias("alternatives"), listed(lambda tag: F.array_contains("tags", tag)).alias("branches"),
        F.count(F.lit(1)).alias("n_files"),
        F.min("file_id").alias("first_file"),
    )


def canonical_number(cell: Column) -> Column:
    """The number that a cell starts with or encloses (`2.5 mm^3`, `<3>`, `~0.1`), else null."""
    return F.regexp_extract(cell, r"^[^0-9A-Za-z.-]?(-?[0-9]+\.?[0-9]*|-?\.[0-9]+)", 1).try_cast("double")


def consistent_table(parsed: DataFrame) -> DataFrame:
    """Every value of every file under one schema: file_id, part_of, row_no, field, type_tag and the typed
    branches as_int, as_decimal, as_text, of which one is set, plus `number`, the canonical conversion.

    Measures have row_no 0, data rows count from 1. A null cell has no branch set; cells beyond the
    header are kept under the field `#<place>`.
    """
    files = distinct_files(parsed)
    width = F.size(F.coalesce("col_headers", F.array().cast("array<string>")))
    rows = files.select("file_id", "col_headers", width.alias("width"), F.posexplode("data_rows").alias("r", "cells")).select(
        "file_id", F.lit("column").alias("part_of"), (F.col("r") + 1).alias("row_no"), "col_headers", F.posexplode("cells").alias("i", "cell")
    ).select("file_id", "part_of", "row_no", F.coalesce(F.get("col_headers", "i"), F.format_string("#%d", "i")).alias("field"), "cell")
    measures = files.select(
        "file_id", F.lit("measure").alias("part_of"), F.lit(0).alias("row_no"), F.explode("header_measures").alias("field", "cell")
    )
    tag = type_tag(F.col("cell"))
    return rows.unionByName(measures).select(
        "file_id", "part_of", "row_no", "field", F.when(F.col("cell").isNotNull(), tag_name(tag)).alias("type_tag"),
        F.when(tag == 0, F.col("cell").try_cast("decimal(38,0)")).alias("as_int"),
        F.when(tag == 1, F.col("cell").try_cast("double")).alias("as_decimal"),
        F.when(tag == 2, F.col("cell")).alias("as_text"),
        canonical_number(F.col("cell")).alias("number"),
    )
