"""Measurement files: from directories, or as text columns, to canonical observation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflux.operators import rejects
from strataflux.operators.vocab import name_key, region_aliases
from strataflux.sources.adapters import listing, walk

VERSION = r"(\d+(?:\.\d+)*)"
FATAL = ("EMPTY_FILE", "NO_COLHEADERS", "NO_DATA_ROWS", "UNKNOWN_TABLE_TYPE", "TRUNCATED_ROW", "COLUMN_COUNT_MISMATCH")
# fixed values: keys of the version and names of the intracranial volume, in order of preference
VERSION_KEYS = ("annotationfileversion", "cvs_version", "AnnotationFileVersion")
ETIV_NAMES = ("EstimatedTotalIntraCranialVol", "eTIV", "IntraCranialVol", "ICV")


def list_files(spark: SparkSession, root: str, pattern: str = "*.stats") -> DataFrame:
    """(source_file, content, size_bytes) of all files under `root`, zero-byte files included.

    The scan leaves out empty files, so they come from a walk of the folders; both are distributed. Bytes that are no UTF-8 are read as Latin-1.
    """
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
        .select(F.col("path").alias("source_file"), F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1")).alias("content"),
                F.sha2("content", 256).alias("source_file_checksum"), F.col("length").alias("size_bytes"))
    )
    # folders are walked in tasks for the files that the scan leaves out
    empty = walk(spark, listing(spark, f"{root.rstrip('/')}/*")).filter((F.col("size") == 0) & ~F.col("is_folder") & F.col("path").endswith(pattern.lstrip("*")))
    return found.unionByName(
        empty.select(F.col("path").alias("source_file"), F.lit("").alias("content"), F.lit(None).cast("string").alias("source_file_checksum"), F.lit(0).cast("bigint").alias("size_bytes"))
    )


def _name(source_file: Column) -> Column:
    return F.coalesce(F.lower(F.substring_index(source_file, "/", -1)), F.lit(""))


def _head(content: Column) -> Column:
    return F.lower(F.substring(F.coalesce(content, F.lit("")), 1, 4000))


def table_type(source_file: Column, content: Column) -> Column:
    """aparc or aseg by the file's name, else by the command that its header names, else null."""
    name, head = _name(source_file), _head(content)
    return (
        F.when(name.contains("aparc"), "aparc").when(name.contains("aseg"), "aseg")
        .when(head.contains("mris_anatomical_stats") | head.contains("aparc.annot"), "aparc")
        .when(head.contains("mri_segstats") | head.contains("aseg.mgz"), "aseg")
    )


def hemisphere(source_file: Column, content: Column) -> Column:
    """lh or rh by the prefix of the file's name, else by the header line `hemi`, else by the command, else null."""
    sides = (
        F.regexp_extract(_name(source_file), r"^(lh|rh)\.", 1), F.regexp_extract(_head(content), r"(?m)^#[ \t]*hemi[ \t]+(lh|rh)[ \t\r]*$", 1),
        F.regexp_extract(_head(content), r"(?: |hemi )(lh|rh) ", 1),
    )
    return F.coalesce(*[F.when(s != "", s) for s in sides])


def header_fields(raw: DataFrame) -> DataFrame:
    """(file_id, line_number, key, value) of `# key value` lines; measures and column lines are none."""
    lines = raw.select("file_id", F.posexplode(F.split("content", "\r?\n")).alias("i", "line")).filter(
        F.col("line").startswith("#") & F.col("line").rlike(r"^#[ \t]*[A-Za-z][A-Za-z0-9_]*[ \t]+\S") & ~F.col("line").rlike(r"^#[ \t]*(Measure|ColHeaders)[ \t]")
    )
    pattern = r"^#[ \t]*([A-Za-z][A-Za-z0-9_]*)[ \t]+(.*?)[ \t]*$"
    return lines.select("file_id", (F.col("i") + 1).alias("line_number"), F.regexp_extract("line", pattern, 1).alias("key"), F.regexp_extract("line", pattern, 2).alias("value"))


def version_of(declaration: Column) -> Column:
    """The leading dotted number of a version declaration, or null."""
    found = F.regexp_extract(F.trim(declaration), "^" + VERSION, 1)
    return F.when(found != "", found)


def file_verdicts(lines: DataFrame) -> DataFrame:
    """(file_id, failure_code, line_number) of files that are rejected as a whole: the first fatal line decides."""
    fatal = lines.filter(F.col("failure_code").isin(*FATAL))
    first = fatal.groupBy("file_id").agg(F.min_by(F.struct("failure_code", "line_number"), "line_number").alias("f"))
    return first.select("file_id", "f.failure_code", F.col("f.line_number").cast("bigint").alias("line_number"))


def all_verdicts(raw: DataFrame, lines: DataFrame) -> DataFrame:
    """`file_verdicts`, and UNKNOWN_TABLE_TYPE for readable files of which neither name nor header tells the table, or the side of a cortical one."""
    bad = file_verdicts(lines)
    kind, side = table_type(F.col("source_file"), F.col("content")), hemisphere(F.col("source_file"), F.col("content"))
    unknown = raw.filter(kind.isNull() | ((kind == "aparc") & side.isNull())).join(bad, "file_id", "left_anti")
    return bad.unionByName(unknown.select("file_id", F.lit("UNKNOWN_TABLE_TYPE").alias("failure_code"), F.lit(0).cast("bigint").alias("line_number")))


def measure_index(lines: DataFrame) -> DataFrame:
    """(file_id, line_number, key, value, overwritten): header measures by short name, and by alias where there is one.

    The number is the last one of the line. The second field is an alias if the number comes after it and it is no number,
    has no blanks and isn't the short name. `overwritten` tells that all keys of the line were taken before it.
    """
    valid = lines.filter("kind = 'measure' AND failure_code IS NULL")
    places = F.filter(F.sequence(F.lit(1), F.size("fields") - 1), lambda i: rejects.is_number(F.get("fields", i)))
    alias = F.get("fields", F.lit(1))
    named = (F.element_at(places, -1) > 1) & (alias != "") & (alias != F.get("fields", F.lit(0))) & ~alias.contains(" ") & ~rejects.is_number(alias)
    keys = F.array_compact(F.array(F.get("fields", F.lit(0)), F.when(named, alias)))
    keyed = valid.select("file_id", "line_number", rejects.as_number(F.get("fields", F.element_at(places, -1))).alias("value"), F.explode(keys).alias("key"))
    taken = F.col("line_number") > F.min("line_number").over(Window.partitionBy("file_id", "key"))
    marked = keyed.withColumn("taken", taken)
    return marked.withColumn("overwritten", F.min("taken").over(Window.partitionBy("file_id", "line_number"))).drop("taken")


def session_globals(raw: DataFrame, lines: DataFrame) -> DataFrame:
    """(file_id, etiv, surface_holes_lh, surface_holes_rh, measures_overwritten, version_declaration, freesurfer_version) per file.

    Of several measures with one key the last holds; an absent count is null, never 0. The version is the number at the start
    of the declaration, null where it starts with none; the declaration stays as written.
    """
    keys = measure_index(lines)
    last = lambda name: F.max_by("value", F.when(F.col("key") == name, F.col("line_number")))
    lost = F.count_if(F.col("overwritten") & (F.col("line_number") != F.coalesce("prior_line", F.lit(-1))))
    by_line = Window.partitionBy("file_id").orderBy("line_number", "key")
    values = keys.withColumn("prior_line", F.lag("line_number").over(by_line)).groupBy("file_id").agg(
        F.coalesce(*[last(n) for n in ETIV_NAMES]).alias("etiv"), last("lhSurfaceHoles").alias("surface_holes_lh"),
        last("rhSurfaceHoles").alias("surface_holes_rh"), lost.alias("measures_overwritten"),
    )
    declared = header_fields(raw).filter(F.col("key").isin(*VERSION_KEYS))
    stated = lambda key: F.max_by("value", F.when(F.col("key") == key, F.col("line_number")))
    versions = declared.groupBy("file_id").agg(F.coalesce(*[stated(k) for k in VERSION_KEYS]).alias("version_declaration"))
    return (
        raw.select("file_id").join(values, "file_id", "left").join(versions, "file_id", "left")
        .withColumns({"freesurfer_version": version_of(F.col("version_declaration")), "measures_overwritten": F.coalesce("measures_overwritten", F.lit(0))})
    )


def canonical_rows(raw: DataFrame, region_set: DataFrame) -> DataFrame:
    """(file_id, source_file, region, hemisphere, measure_type, unit, value) of files that are not rejected.

    Subcortical tables give volumes, cortical tables thicknesses of their side; names outside the
    vocabulary give nothing.
    """
    lines = rejects.read_permissively(raw)
    cells = rejects.loaded_rows(lines).filter(F.col("column_name").isin("Volume_mm3", "ThickAvg"))
    kind, side = table_type(F.col("source_file"), F.col("content")), hemisphere(F.col("source_file"), F.col("content"))
    files = raw.select("file_id", "source_file", kind.alias("kind"), side.alias("side"))
    sound = files.join(all_verdicts(raw, lines), "file_id", "left_anti")
    typed = cells.join(sound, "file_id").filter(
        ((F.col("kind") == "aseg") & (F.col("column_name") == "Volume_mm3")) | ((F.col("kind") == "aparc") & (F.col("column_name") == "ThickAvg"))
    )
    aliases = region_aliases(region_set)
    key = F.translate(name_key(F.col("struct_name")), " ", "-")
    named = typed.withColumns({"alias": key, "side": F.when(F.col("kind") == "aseg", F.lit("")).otherwise(F.col("side"))})
    measures = region_set.select(F.col("region").alias("canon_region"), "hemisphere", "measure_type", "unit")
    return (
        named.join(aliases, ["alias", "side"]).join(measures, "canon_region")
        .filter(F.col("measure_type") == F.when(F.col("kind") == "aseg", "volume").otherwise("thickness"))
        .select("file_id", "source_file", F.col("canon_region").alias("region"), "hemisphere", "measure_type", "unit", "value")
    )
