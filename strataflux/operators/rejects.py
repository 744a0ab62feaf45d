"""Whole measurement files as text: every valid row and header measure loaded, every bad line with its reason.

Each line is read permissively under the column list that its own file declares: split at blanks or commas, one double
per column but the name. What doesn't read that way keeps its raw text in `_corrupt_record`. Only these lines are then
classified by quoting, field count and number checks, in this order; some of them turn out legal (quoted fields,
decimal commas) and are loaded too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: the column list of a subcortical file that declares none
DEFAULT_COLUMNS = (
    "Index", "SegId", "NVoxels", "Volume_mm3", "StructName", "normMean", "normStdDev", "normMin", "normMax", "normRange",
)
NAME_COLUMN = "StructName"
#: a data field is a run without blanks and quotes, or whatever two quotes at its ends enclose
FIELD = r'"[^"]*"|[^ \t"]+'
#: possessive groups: their matching is a loop, where a plain one recurses per field and overflows on long lines
LEGAL_ROW = rf"^[ \t]*({FIELD})([ \t]+({FIELD}))*+[ \t]*$"
#: a measure field lies between commas; quoted, it may hold commas itself
LEGAL_MEASURE = r'^[ \t]*("[^"]*"|[^",]*)[ \t]*(,[ \t]*("[^"]*"|[^",]*)[ \t]*)*+$'
MEASURE_FIELD = r'(?:^|,)([ \t]*"[^"]*"[ \t]*|[^,]*)'
HEADER, MEASURE = r"^#[ \t]*ColHeaders(?:[ \t]+(.*))?$", r"^#[ \t]*Measure(?:[ \t]+(.*))?$"


def is_number(text: Column) -> Column:
    """Sign, digits with at most one point or comma, exponent; sign and exponent are optional."""
    known = (F.translate(text, "0123456789+-.,eE", "") == "") & F.translate(text, ",", ".").try_cast("double").isNotNull()
    return F.coalesce(known, F.lit(False))


def as_number(text: Column) -> Column:
    """The double that a number in this format stands for; a comma is a decimal comma."""
    return F.when(is_number(text), F.translate(text, ",", ".").try_cast("double"))


def plain_fields(line: Column) -> Column:
    """Runs without blanks."""
    return F.array_remove(F.split(F.translate(line, "\t", " "), " "), "")


def unquoted(field: Column) -> Column:
    return F.when(field.rlike(r'^".*"$'), field.substr(F.lit(2), F.length(field) - 2)).otherwise(field)


def fields_of(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(f"({FIELD})"), F.lit(1))


def measure_fields(body: Column) -> Column:
    return F.transform(F.regexp_extract_all(body, F.lit(MEASURE_FIELD), F.lit(1)), lambda x: unquoted(F.trim(F.translate(x, "\t", " "))))


def tagged_lines(raw: DataFrame) -> DataFrame:
    """One row per file with its line list and column list, and the code of files that have no readable table."""
    lines = F.split(F.replace(F.coalesce("content", F.lit("")), F.lit("\r\n"), F.lit("\n")), "\n")

    def is_data(x: Column) -> Column:
        return ~x.startswith("#") & (F.btrim(x, F.lit(" \t")) != "")

    base = raw.select("file_id", "source_file", "content", lines.alias("lines"))
    declared = F.get(F.filter("lines", lambda x: x.startswith("#") & x.rlike(HEADER)), F.lit(0))
    subcortical = F.coalesce(F.lower("source_file").rlike(r"aseg[^/]*$"), F.lit(False))
    head = F.lower(F.substring(F.coalesce("content", F.lit("")), 1, 4000))
    named = F.coalesce(F.lower(F.substring_index("source_file", "/", -1)).rlike("aparc|aseg"), F.lit(False))
    cortical = head.contains("mris_anatomical_stats") | head.contains("aparc.annot")
    subcortical = subcortical | (~named & ~cortical & (head.contains("mri_segstats") | head.contains("aseg.mgz")))
    default = F.array(*[F.lit(c) for c in DEFAULT_COLUMNS])
    read = base.withColumn("declared", declared).withColumn(
        "cols",
        F.when(F.col("declared").isNotNull(), F.transform(fields_of(F.regexp_extract("declared", HEADER, 1)), unquoted)).when(
            subcortical, default
        ),
    )
    blank = ~F.coalesce(F.col("content").rlike(r"\S"), F.lit(False))
    code = (
        F.when(blank, "EMPTY_FILE")
        .when(F.col("cols").isNull(), "NO_COLHEADERS")
        .when(~F.exists("lines", is_data), "NO_DATA_ROWS")
    )
    return read.select("file_id", "source_file", "lines", "cols", code.alias("file_code"))


def read_permissively(raw: DataFrame) -> DataFrame:
    """Every data and measure line of every file: file_id, line_number, kind, fields, cols, `_corrupt_record`
    (the raw line, where the plain read doesn't fit it) and failure_code, null for what is loaded; a file without a
    readable table is one row with line_number 0 and kind `file`.

    Null content counts as empty. Blank lines and comments carry nothing. A line of any length is one line;
    only \\n and \\r\\n end it. Repeated deliveries of a file are files of their own. Of several ColHeaders
    lines the first one holds.
    """
    whole = F.col("file_code").isNotNull()
    lines = tagged_lines(raw).select(
        "file_id", "file_code", F.when(~whole, F.col("cols")).alias("cols"), F.array_position("cols", NAME_COLUMN).alias("name_at"),
        F.posexplode(F.when(whole, F.array(F.lit(""))).otherwise(F.col("lines"))).alias("i", "line"),
    )
    comment = F.col("line").startswith("#")
    kind = (
        F.when(whole, "file").when(comment & F.col("line").rlike(MEASURE), "measure")
        .when(~comment & (F.btrim("line", F.lit(" \t")) != ""), "row")
    )
    body = F.when(kind == "measure", F.regexp_extract("line", MEASURE, 1)).otherwise(F.col("line"))
    is_row, quoted = F.col("kind") == "row", F.col("body").contains('"')
    split = F.when(is_row, plain_fields(F.col("body"))).otherwise(F.transform(F.split("body", ","), lambda x: F.btrim(x, F.lit(" \t"))))
    numbers = F.transform(F.slice("plain", F.lit(2), F.size("plain")), as_number)
    # one double per column but the name's; the cast also reads words like NaN, which the characters rule out
    doubles = F.col("plain").try_cast("array<double>")
    name = F.coalesce(F.get("plain", F.col("name_at").cast("int") - 1), F.lit(""))
    characters = F.translate(F.array_join(F.array_remove("plain", name), ""), "0123456789+-.eE", "") == ""
    nameless = F.when(F.col("name_at") > 0, F.get(doubles, F.col("name_at").cast("int") - 1).isNull().cast("int")).otherwise(F.lit(0))
    typed = characters & (F.size(F.array_compact(doubles)) + nameless == F.size("plain"))
    conforms = ~quoted & F.when(is_row, (F.size("plain") == F.size("cols")) & typed).otherwise((F.get("plain", F.lit(0)) != "") & F.exists(numbers, lambda x: x.isNotNull()))
    read = lines.withColumns({"kind": kind, "body": body}).filter("kind IS NOT NULL").withColumn("plain", split)
    permissive = read.withColumn("_corrupt_record", F.when((F.col("kind") != "file") & ~F.coalesce(conforms, F.lit(False)), F.col("line")))

    corrupt = F.col("_corrupt_record").isNotNull()
    # without quotes the plain fields are the legal ones
    exact = F.when(is_row, F.transform(fields_of(F.col("body")), unquoted)).otherwise(measure_fields(F.col("body")))
    legal = F.when(is_row, F.col("body").rlike(LEGAL_ROW)).otherwise(F.col("body").rlike(LEGAL_MEASURE))
    parsed = permissive.withColumns({"fields": F.when(quoted, exact).otherwise(F.col("plain")), "quotes_ok": F.when(quoted, legal).otherwise(F.lit(True))})
    numbers_ok = F.forall(
        F.zip_with("cols", "fields", lambda c, f: (c == NAME_COLUMN) | is_number(f)), lambda ok: F.coalesce(ok, F.lit(False))
    )
    of_row = (
        F.when(F.size("fields") < F.size("cols"), "TRUNCATED_ROW")
        .when(F.size("fields") > F.size("cols"), "COLUMN_COUNT_MISMATCH")
        .when(~numbers_ok, "UNPARSEABLE_NUMERIC")
    )
    first_empty = F.coalesce(F.get("fields", F.lit(0)), F.lit("")) == ""
    has_number = F.exists(F.slice("fields", F.lit(2), F.size("fields")), is_number)
    of_measure = F.when(first_empty | ~has_number, "MALFORMED_MEASURE")
    code = F.when(corrupt, F.when(~F.col("quotes_ok"), "BROKEN_QUOTING").when(is_row, of_row).otherwise(of_measure))
    verdict = F.struct(
        "file_id", F.when(whole, F.lit(0)).otherwise(F.col("i") + 1).alias("line_number"), "kind", F.when(~whole, F.col("fields")).alias("fields"), "cols",
        "_corrupt_record", F.coalesce("file_code", code).alias("failure_code"),
    )
    # a generator, since a filter on the code would otherwise be moved below all of this and compute it again
    return parsed.select(F.explode(F.array(verdict)).alias("r")).select("r.*")


def rejected(lines: DataFrame) -> DataFrame:
    """(file_id, line_number, failure_code, _corrupt_record) of what could not be loaded."""
    return lines.filter("failure_code IS NOT NULL").select(
        "file_id", F.col("line_number").cast("bigint").alias("line_number"), "failure_code", "_corrupt_record"
    )


def loaded_rows(lines: DataFrame) -> DataFrame:
    """Valid data rows in long form: file_id, line_number, struct_name, column_name, value."""
    valid = lines.filter("kind = 'row' AND failure_code IS NULL")
    name = F.get(F.filter(F.arrays_zip("cols", "fields"), lambda x: x["cols"] == NAME_COLUMN), F.lit(0))["fields"]
    cells = valid.select(
        "file_id", F.col("line_number").cast("bigint").alias("line_number"), name.alias("struct_name"), F.explode(F.arrays_zip("cols", "fields")).alias("c")
    )
    return cells.filter(F.col("c.cols") != NAME_COLUMN).select(
        "file_id", "line_number", "struct_name", F.col("c.cols").alias("column_name"), as_number(F.col("c.fields")).alias("value")
    )


def loaded_measures(lines: DataFrame) -> DataFrame:
    """Valid header measures: file_id, line_number, measure (short name), value (last number), unit (last field)."""
    valid = lines.filter("kind = 'measure' AND failure_code IS NULL")
    numbers = F.filter(F.slice("fields", F.lit(2), F.size("fields")), is_number)
    return valid.select(
        "file_id", F.col("line_number").cast("bigint").alias("line_number"), F.get("fields", F.lit(0)).alias("measure"),
        as_number(F.element_at(numbers, -1)).alias("value"), F.element_at("fields", -1).alias("unit"),
    )
