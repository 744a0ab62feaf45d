"""SQL equivalents, for DuckDB, of the queries of this package."""

from __future__ import annotations

#: region and measure_type in canonical form; a spelling outside the vocabulary stays as its comparison key
CANONICAL = """
names AS (
  SELECT DISTINCT replace(lower(trim(a)), '_', '-') AS alias, side, canon FROM (
    SELECT unnest(list_prepend(region, source_names)) AS a, '' AS side, region AS canon FROM region_set
    UNION ALL SELECT structure, hemisphere, region FROM region_set) t),
obs AS (
  SELECT o.* EXCLUDE (region, measure_type),
         coalesce(a.canon, b.canon, replace(lower(trim(o.region)), '_', '-')) AS region,
         lower(trim(o.measure_type)) AS measure_type
  FROM observations o
  LEFT JOIN names a ON a.side = '' AND a.alias = replace(lower(trim(o.region)), '_', '-')
  LEFT JOIN names b ON b.side <> '' AND b.alias = replace(lower(trim(o.region)), '_', '-') AND b.side = lower(trim(o.hemisphere)))
"""

SQL: dict[str, str] = {}

READINGS = f"""
{CANONICAL},
r AS (
  SELECT 'value' AS field, site, region, measure_type, subject_id, session_id, dataset_version, value AS x, min(acquired_at) AS t
  FROM obs WHERE site IS NOT NULL AND value IS NOT NULL AND measure_type IN ('volume', 'thickness') GROUP BY ALL
  UNION ALL
  SELECT 'etiv', site, '*', '*', subject_id, session_id, dataset_version, etiv, min(acquired_at)
  FROM obs WHERE site IS NOT NULL AND etiv IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'surface_holes_lh', site, '*', '*', subject_id, session_id, dataset_version, surface_holes_lh, min(acquired_at)
  FROM obs WHERE site IS NOT NULL AND surface_holes_lh IS NOT NULL GROUP BY ALL),
med AS (SELECT field, site, region, measure_type, median(x) AS m FROM r WHERE isfinite(x) GROUP BY ALL),
mad AS (SELECT field, site, region, measure_type, any_value(m) AS m, median(abs(x - m)) AS d
        FROM r JOIN med USING (field, site, region, measure_type) WHERE isfinite(x) GROUP BY ALL),
lagged AS (SELECT *, CASE WHEN lag(x) OVER w = x THEN 0 ELSE 1 END AS starts FROM r WHERE field <> 'surface_holes_lh'
           WINDOW w AS (PARTITION BY field, site, region, measure_type, dataset_version ORDER BY t, subject_id, session_id, x)),
runs AS (SELECT *, sum(starts) OVER (PARTITION BY field, site, region, measure_type, dataset_version
                                     ORDER BY t, subject_id, session_id, x ROWS UNBOUNDED PRECEDING) AS run FROM lagged),
stuck AS (SELECT * FROM runs QUALIFY count(*) OVER (PARTITION BY field, site, region, measure_type, dataset_version, run) >= 5),
flags AS (
  SELECT field, site, region, measure_type, subject_id, session_id, 'limit' AS kind FROM r
  WHERE NOT isfinite(x) OR (field <> 'surface_holes_lh' AND x <= 0) OR (field = 'surface_holes_lh' AND (x < 0 OR x <> floor(x)))
  UNION ALL
  SELECT field, site, region, measure_type, subject_id, session_id, 'apart' FROM r JOIN mad USING (field, site, region, measure_type)
  WHERE isfinite(x) AND abs(x - m) > 8 * 1.4826 * d
  UNION ALL
  SELECT field, site, region, measure_type, subject_id, session_id, 'stuck' FROM stuck)
"""
SQL["p1_found"] = f"WITH {READINGS} SELECT DISTINCT field, subject_id, session_id, region FROM flags"
SQL["p1_flags"] = f"WITH {READINGS} SELECT DISTINCT * FROM flags"

SQL["p2_found"] = f"""
WITH {CANONICAL}
SELECT subject_id, session_id, region, measure_type FROM obs
WHERE value IS NOT NULL AND NOT isnan(value)
GROUP BY ALL HAVING count(DISTINCT value) > 1
"""

#: fixed values: what the columns of the wide table are called after, the regions of the vocabulary and the measures
STRUCTURES = {
    "volume": ("hippocampus", "amygdala", "thalamus", "caudate", "putamen", "lateral-ventricle", "inferior-lateral-ventricle"),
    "thickness": ("entorhinal", "parahippocampal", "inferiorparietal", "precuneus", "posteriorcingulate", "middletemporal", "superiorfrontal"),
}
WIDE = [(f"{side}-{s}", m) for m, names in STRUCTURES.items() for s in names for side in ("lh", "rh")]
WIDE += [(r, "area") for r, m in WIDE if m == "thickness"]
CELLS_WIDE = ", ".join(f"max(value) FILTER (region = '{r}' AND measure_type = '{m}') AS {r.replace('-', '_')}__{m}" for r, m in WIDE)
SQL["p2_wide_table"] = f"""
WITH {CANONICAL},
v AS (SELECT subject_id, session_id, region, measure_type, CASE WHEN NOT isnan(value) THEN value END AS value, ingested_at FROM obs),
cells AS (SELECT subject_id, session_id, region, measure_type, first(value ORDER BY ingested_at DESC NULLS LAST, value DESC) FILTER (value IS NOT NULL) AS value,
                 count(DISTINCT value) > 1 AS conflict FROM v GROUP BY ALL)
SELECT subject_id, session_id, {CELLS_WIDE}, count(*) FILTER (conflict) AS n_conflicts FROM cells GROUP BY subject_id, session_id
"""

#: every schema change: columns with their place and type per file, compared with the file before
SQL["p3_found"] = """
WITH f AS (SELECT DISTINCT ON (file_id) * FROM parsed_files ORDER BY file_id, received_at),
o AS (SELECT *, lag(file_id) OVER (PARTITION BY stream_id ORDER BY seq, file_id) AS prev FROM f),
heads AS (SELECT file_id, unnest(col_headers) AS field, generate_subscripts(col_headers, 1) AS place FROM f),
rows_ AS (SELECT file_id, unnest(data_rows) AS r FROM f),
cells AS (SELECT h.file_id, h.field, h.place, r.r[h.place] AS c FROM heads h LEFT JOIN rows_ r USING (file_id)),
meas AS (SELECT file_id, unnest(map_keys(header_measures)) AS field, unnest(map_values(header_measures)) AS c FROM f),
typed AS (
  SELECT file_id, part_of, field, place,
         coalesce(max(CASE WHEN regexp_full_match(c, '[0-9]+') THEN 0 WHEN regexp_full_match(c, '[0-9]+\\.[0-9]*|\\.[0-9]+') THEN 1
                           WHEN c IS NOT NULL THEN 2 END), 0) AS tag
  FROM (SELECT file_id, 'column' AS part_of, field, place, c FROM cells
        UNION ALL SELECT file_id, 'measure', field, 0, c FROM meas) t GROUP BY ALL),
was AS (SELECT o.file_id, t.part_of, t.field, t.place, t.tag FROM o JOIN typed t ON t.file_id = o.prev),
now AS (SELECT t.* FROM typed t JOIN o USING (file_id) WHERE o.prev IS NOT NULL),
gone AS (SELECT * FROM was ANTI JOIN now USING (file_id, part_of, field)),
come AS (SELECT * FROM now ANTI JOIN was USING (file_id, part_of, field)),
single AS (SELECT file_id FROM gone WHERE part_of = 'measure' GROUP BY 1 HAVING count(*) = 1
           INTERSECT SELECT file_id FROM come WHERE part_of = 'measure' GROUP BY 1 HAVING count(*) = 1),
renamed AS (
  SELECT g.file_id, g.part_of, g.field, c.field AS new_field FROM gone g JOIN come c USING (file_id, part_of)
  WHERE (g.part_of = 'column' AND g.place = c.place AND g.tag = c.tag)
     OR (g.part_of = 'measure' AND g.file_id IN (SELECT file_id FROM single)))
SELECT file_id, part_of, 'renamed' AS change, field, new_field FROM renamed
UNION ALL SELECT file_id, part_of, 'removed', field, '' FROM gone ANTI JOIN renamed USING (file_id, part_of, field)
UNION ALL SELECT file_id, part_of, 'added', field, '' FROM come
  ANTI JOIN (SELECT file_id, part_of, new_field AS field FROM renamed) r USING (file_id, part_of, field)
UNION ALL SELECT n.file_id, n.part_of, 'type_changed', n.field, '' FROM now n JOIN was w USING (file_id, part_of, field) WHERE n.tag <> w.tag
"""

SQL["p3_fused_schema"] = """
WITH f AS (SELECT DISTINCT ON (file_id) * FROM parsed_files ORDER BY file_id, received_at),
heads AS (SELECT file_id, unnest(col_headers) AS field, generate_subscripts(col_headers, 1) AS place FROM f),
rows_ AS (SELECT file_id, unnest(data_rows) AS r FROM f),
all_ AS (SELECT h.file_id, 'column' AS part_of, h.field, r.r[h.place] AS c FROM heads h LEFT JOIN rows_ r USING (file_id)
         UNION ALL SELECT file_id, 'measure', unnest(map_keys(header_measures)), unnest(map_values(header_measures)) FROM f),
typed AS (SELECT DISTINCT file_id, part_of, field,
                 CASE WHEN regexp_full_match(c, '[0-9]+') THEN 'int' WHEN regexp_full_match(c, '[0-9]+\\.[0-9]*|\\.[0-9]+') THEN 'decimal'
                      WHEN c IS NOT NULL THEN 'text' END AS t FROM all_),
held AS (SELECT file_id, part_of, field, coalesce(t, CASE WHEN count(t) OVER (PARTITION BY file_id, part_of, field) = 0 THEN 'int' END) AS t FROM typed),
per_file AS (SELECT file_id, part_of, field, max(t) FILTER (t IS NOT NULL) AS any_t, bool_or(t = 'text') AS is_text, bool_or(t = 'decimal') AS is_decimal FROM held GROUP BY ALL),
wide AS (SELECT part_of, field, string_agg(DISTINCT w, '|' ORDER BY w) AS alternatives
         FROM (SELECT part_of, field, CASE WHEN is_text THEN 'text' WHEN is_decimal THEN 'decimal' ELSE 'int' END AS w FROM per_file) t GROUP BY part_of, field)
SELECT part_of, field, any_value(alternatives) AS alternatives, string_agg(DISTINCT t, '|' ORDER BY t) AS branches, count(DISTINCT file_id) AS n_files, min(file_id) AS first_file
FROM held JOIN wide USING (part_of, field) GROUP BY part_of, field
"""

SQL["p3_consistent_table"] = r"""
WITH f AS (SELECT DISTINCT ON (file_id) * FROM parsed_files ORDER BY file_id, received_at),
rows_ AS (SELECT file_id, col_headers, unnest(data_rows) AS r, generate_subscripts(data_rows, 1) AS row_no FROM f),
cells AS (SELECT file_id, 'column' AS part_of, row_no, col_headers, unnest(r) AS cell, generate_subscripts(r, 1) AS i FROM rows_),
all_ AS (SELECT file_id, part_of, row_no, coalesce(col_headers[i], '#' || (i - 1)) AS field, cell FROM cells
         UNION ALL SELECT file_id, 'measure', 0, unnest(map_keys(header_measures)), unnest(map_values(header_measures)) FROM f),
t AS (SELECT *, CASE WHEN regexp_full_match(cell, '[0-9]+') THEN 'int' WHEN regexp_full_match(cell, '[0-9]+\.[0-9]*|\.[0-9]+') THEN 'decimal' WHEN cell IS NOT NULL THEN 'text' END AS type_tag FROM all_)
SELECT file_id, part_of, row_no, field, type_tag, CASE WHEN type_tag = 'int' THEN cell::DECIMAL(38, 0) END AS as_int, CASE WHEN type_tag = 'decimal' THEN cell::DOUBLE END AS as_decimal,
       CASE WHEN type_tag = 'text' THEN cell END AS as_text,
       try_cast(nullif(regexp_extract(cell, '^[^0-9A-Za-z.-]?(-?[0-9]+\.?[0-9]*|-?\.[0-9]+)', 1), '') AS DOUBLE) AS number
FROM t
"""

#: lines of raw_stats with their kind, fields and the columns that hold for their file
LINES = r"""
l AS (SELECT file_id, source_file, content, unnest(regexp_split_to_array(content, '\r?\n')) AS line,
             generate_subscripts(regexp_split_to_array(content, '\r?\n'), 1) AS n FROM raw_stats),
k AS (SELECT *, CASE WHEN regexp_matches(line, '^#[ \t]*ColHeaders([ \t]|$)') THEN 'head' WHEN regexp_matches(line, '^#[ \t]*Measure([ \t]|$)') THEN 'measure'
                     WHEN line NOT LIKE '#%' AND regexp_matches(line, '[^ \t]') THEN 'row' END AS kind FROM l),
heads AS (SELECT file_id, arg_min(line, n) AS line FROM k WHERE kind = 'head' GROUP BY 1),
cols AS (
  SELECT r.file_id, CASE WHEN h.line IS NOT NULL
           THEN regexp_extract_all(regexp_replace(h.line, '^#[ \t]*ColHeaders', ''), '[^ \t"]+')
         WHEN regexp_matches(lower(source_file), 'aseg[^/]*$') THEN
           ['Index', 'SegId', 'NVoxels', 'Volume_mm3', 'StructName', 'normMean', 'normStdDev', 'normMin', 'normMax', 'normRange'] END AS cols
  FROM raw_stats r LEFT JOIN heads h USING (file_id)),
whole AS (
  SELECT r.file_id, CASE WHEN content IS NULL OR NOT regexp_matches(content, '\S') THEN 'EMPTY_FILE' WHEN cols IS NULL THEN 'NO_COLHEADERS'
    WHEN r.file_id NOT IN (SELECT file_id FROM k WHERE kind = 'row') THEN 'NO_DATA_ROWS' END AS code
  FROM raw_stats r JOIN cols USING (file_id)),
b AS (SELECT k.file_id, n, kind, cols, line, CASE WHEN kind = 'measure' THEN regexp_replace(line, '^#[ \t]*Measure', '') ELSE line END AS body
      FROM k JOIN whole w USING (file_id) JOIN cols USING (file_id) WHERE w.code IS NULL AND kind IN ('row', 'measure')),
p AS (SELECT *, CASE WHEN kind = 'row' THEN regexp_full_match(body, '[ \t]*("[^"]*"|[^ \t"]+)([ \t]+("[^"]*"|[^ \t"]+))*[ \t]*')
                     ELSE regexp_full_match(body, '[ \t]*("[^"]*"|[^",]*)[ \t]*(,[ \t]*("[^"]*"|[^",]*)[ \t]*)*') END AS sound,
      CASE WHEN kind = 'row' THEN list_transform(regexp_extract_all(body, '"[^"]*"|[^ \t"]+'), lambda x: replace(x, '"', ''))
           ELSE list_transform(regexp_extract_all(body, '(?:^|,)([ \t]*"[^"]*"[ \t]*|[^,]*)', 1), lambda x: replace(trim(x, chr(9) || ' '), '"', '')) END AS fields
      FROM b),
c AS (SELECT *, CASE WHEN NOT sound THEN 'BROKEN_QUOTING'
   WHEN kind = 'row' AND len(fields) < len(cols) THEN 'TRUNCATED_ROW' WHEN kind = 'row' AND len(fields) > len(cols) THEN 'COLUMN_COUNT_MISMATCH'
   WHEN kind = 'row' AND len(list_filter(list_zip(cols, fields), lambda x: x[1] <> 'StructName'
        AND NOT regexp_full_match(x[2], '[+-]?([0-9]+[.,]?[0-9]*|[.,][0-9]+)([eE][+-]?[0-9]+)?'))) > 0 THEN 'UNPARSEABLE_NUMERIC'
   WHEN kind = 'measure' AND (fields[1] = '' OR len(list_filter(fields[2:],
        lambda x: regexp_full_match(x, '[+-]?([0-9]+[.,]?[0-9]*|[.,][0-9]+)([eE][+-]?[0-9]+)?'))) = 0) THEN 'MALFORMED_MEASURE' END AS code FROM p)
"""

SQL["p4_found"] = f"""
WITH {LINES}
SELECT file_id, 0::BIGINT AS line_number, code AS failure_code FROM whole WHERE code IS NOT NULL
UNION ALL SELECT file_id, n::BIGINT, code FROM c WHERE code IS NOT NULL
"""

SQL["p4_loaded_rows"] = f"""
WITH {LINES},
v AS (SELECT file_id, n, list_zip(cols, fields) AS z FROM c WHERE kind = 'row' AND code IS NULL),
e AS (SELECT file_id, n, list_filter(z, lambda x: x[1] = 'StructName')[1][2] AS struct_name, unnest(z) AS x FROM v)
SELECT file_id, n::BIGINT AS line_number, struct_name, x[1] AS column_name, replace(x[2], ',', '.')::DOUBLE AS value
FROM e WHERE x[1] <> 'StructName'
"""

SQL["p4_loaded_measures"] = f"""
WITH {LINES}
SELECT file_id, n::BIGINT AS line_number, fields[1] AS measure,
       replace(list_last(list_filter(fields[2:], lambda x: regexp_full_match(x, '[+-]?([0-9]+[.,]?[0-9]*|[.,][0-9]+)([eE][+-]?[0-9]+)?'))), ',', '.')::DOUBLE AS value,
       list_last(fields) AS unit
FROM c WHERE kind = 'measure' AND code IS NULL
"""

NUMERIC = "'[+-]?([0-9]+[.,]?[0-9]*|[.,][0-9]+)([eE][+-]?[0-9]+)?'"
KEYVAL = r"^#[ \t]*([A-Za-z][A-Za-z0-9_]*)[ \t]+(.*?)[ \t]*$"
HEADERS = rf"""
h AS (SELECT file_id, n, regexp_extract(line, '{KEYVAL}', 1) AS key, regexp_extract(line, '{KEYVAL}', 2) AS value
      FROM l WHERE regexp_matches(line, '^#[ \t]*[A-Za-z][A-Za-z0-9_]*[ \t]+\S') AND NOT regexp_matches(line, '^#[ \t]*(Measure|ColHeaders)[ \t]'))
"""
#: measures by short name and alias, the last line of a key holds; a line whose keys were all taken before is overwritten
SQL["file_globals"] = rf"""
WITH {LINES}, {HEADERS},
m AS (SELECT file_id, n, fields, list_max(list_filter(range(2, len(fields) + 1), lambda i: regexp_full_match(fields[i], {NUMERIC}))) AS spot
      FROM c WHERE kind = 'measure' AND code IS NULL),
a AS (SELECT *, spot > 2 AND fields[2] NOT IN ('', fields[1]) AND fields[2] NOT LIKE '% %' AND NOT regexp_full_match(fields[2], {NUMERIC}) AS has_alias FROM m),
keyed AS (SELECT file_id, n, unnest(CASE WHEN has_alias THEN [fields[1], fields[2]] ELSE [fields[1]] END) AS key, replace(fields[spot], ',', '.')::DOUBLE AS value FROM a),
first_ AS (SELECT file_id, key, min(n) AS f FROM keyed GROUP BY ALL),
over_ AS (SELECT file_id, count(*) AS k FROM (SELECT keyed.file_id, keyed.n FROM keyed JOIN first_ USING (file_id, key) GROUP BY 1, 2 HAVING bool_and(keyed.n > f)) t GROUP BY 1),
v AS (SELECT file_id, key, arg_max(value, n) AS value FROM keyed GROUP BY ALL),
g AS (SELECT file_id, coalesce(max(value) FILTER (key = 'EstimatedTotalIntraCranialVol'), max(value) FILTER (key = 'eTIV'),
             max(value) FILTER (key = 'IntraCranialVol'), max(value) FILTER (key = 'ICV')) AS etiv,
             max(value) FILTER (key = 'lhSurfaceHoles') AS surface_holes_lh, max(value) FILTER (key = 'rhSurfaceHoles') AS surface_holes_rh FROM v GROUP BY 1),
d AS (SELECT file_id, coalesce(arg_max(value, n) FILTER (key = 'annotationfileversion'), arg_max(value, n) FILTER (key = 'cvs_version'),
             arg_max(value, n) FILTER (key = 'AnnotationFileVersion')) AS version_declaration FROM h GROUP BY 1)
SELECT r.file_id, etiv, surface_holes_lh, surface_holes_rh, coalesce(o.k, 0)::BIGINT AS measures_overwritten, version_declaration,
       nullif(regexp_extract(version_declaration, '^(\d+(?:\.\d+)*)', 1), '') AS freesurfer_version
FROM raw_stats r LEFT JOIN g USING (file_id) LEFT JOIN d USING (file_id) LEFT JOIN over_ o USING (file_id)
"""

PROFILE = """
cells AS (
  SELECT dataset_version, 'surface_holes_lh' AS column_name, surface_holes_lh AS num, NULL::VARCHAR AS txt FROM observations
  UNION ALL SELECT dataset_version, 'field_strength_tesla', field_strength_tesla, NULL FROM observations
  UNION ALL SELECT dataset_version, 'freesurfer_version', NULL, freesurfer_version FROM observations
  UNION ALL SELECT dataset_version, 'sex', NULL, sex FROM observations)
"""

SQL["p5_found"] = f"""
WITH {PROFILE},
s AS (
  SELECT dataset_version, c.column_name, count(*) AS n, count(*) FILTER (num IS NULL AND txt IS NULL) AS n_null,
         count(DISTINCT num) + count(DISTINCT txt) AS n_distinct, median(num) FILTER (NOT isnan(num)) AS med,
         count(*) FILTER (num < min_value OR num > max_value) AS outside,
         count(*) FILTER (NOT regexp_full_match(txt, value_pattern)) AS bad,
         count(*) FILTER (txt = top_value) AS top
  FROM cells c LEFT JOIN profile_baseline b USING (column_name) GROUP BY ALL)
SELECT dataset_version, column_name, finding FROM (
  SELECT dataset_version, column_name, unnest([
    CASE WHEN abs(s.n_null / n - b.null_share) > 0.08 THEN 'null_rate' END,
    CASE WHEN s.n_distinct > 2 * b.n_distinct THEN 'distinct' END,
    CASE WHEN b.min_value IS NOT NULL AND outside / nullif(n - n_null, 0) > 0.01 THEN 'range' END,
    CASE WHEN b.value_pattern IS NOT NULL AND bad / nullif(n - n_null, 0) > 0.01 THEN 'pattern' END,
    CASE WHEN b.median_value IS NOT NULL AND abs(med - b.median_value) > 0.5 * b.iqr_value THEN 'shift'
         WHEN b.median_value IS NULL AND abs(top / nullif(n - n_null, 0) - b.top_share) > 0.15 THEN 'shift' END]) AS finding
  FROM s JOIN profile_baseline b USING (column_name)) t
WHERE finding IS NOT NULL
"""

SQL["p5_profile"] = f"""
WITH {PROFILE},
v AS (SELECT dataset_version, column_name, num, txt, count(*) AS k FROM cells GROUP BY ALL),
t AS (SELECT dataset_version, column_name, k, coalesce(num::VARCHAR, txt) AS shown FROM v WHERE num IS NOT NULL OR txt IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY dataset_version, column_name ORDER BY k DESC, coalesce(num::VARCHAR, txt) DESC) = 1),
s AS (SELECT dataset_version, column_name, count(*) AS n_rows, count(*) FILTER (num IS NULL AND txt IS NULL) AS n_null,
             count(DISTINCT num) + count(DISTINCT txt) AS n_distinct, min(num) AS min_num, max(num) AS max_num, min(txt) AS min_txt,
             max(txt) AS max_txt, quantile_cont(num, 0.25) AS q1, median(num) AS median, quantile_cont(num, 0.75) AS q3
      FROM cells GROUP BY ALL)
SELECT s.*, shown AS top_value, round(k / (n_rows - n_null), 6) AS top_share FROM s LEFT JOIN t USING (dataset_version, column_name)
"""

#: the hierarchy of expressions over the distinct text values, and the one chosen for each by description length
INDUCED = rf"""
{PROFILE},
v AS (SELECT dataset_version AS load, column_name, txt, count(*) AS k FROM cells WHERE txt IS NOT NULL GROUP BY ALL),
shaped AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(txt, '[a-z]', 'a', 'g'), '[A-Z]', 'A', 'g'), '[0-9]', 'd', 'g') AS n1 FROM v),
leaves AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(n1, 'd+', 'd', 'g'), 'a+', 'a', 'g'), 'A+', 'A', 'g') AS n2,
                  (length(n1) - length(replace(n1, 'd', ''))) * 3.33::DOUBLE + (length(n1) - length(replace(replace(n1, 'a', ''), 'A', ''))) * 4.71::DOUBLE AS opened FROM shaped),
bits AS (SELECT *, greatest(length(txt), 1) * 8.0::DOUBLE AS b0, opened + length(n2) * 2 * log2(length(txt) + 1.0::DOUBLE) AS b2, length(txt) * 8.0::DOUBLE + 8 AS b3 FROM leaves),
l1 AS (SELECT load, column_name, n1, n2, sum(b0) AS below, length(n1) * 8 + sum(opened) AS own, sum(b2) AS b2, sum(b3) AS b3 FROM bits GROUP BY load, column_name, n1, n2),
l2 AS (SELECT load, column_name, n2, sum(least(own, below)) AS below, length(n2) * 16 + sum(b2) AS own, sum(b3) AS b3 FROM l1 GROUP BY load, column_name, n2),
l3 AS (SELECT load, column_name, sum(least(own, below)) AS below, sum(b3) + 16 AS own FROM l2 GROUP BY load, column_name),
levelled AS (
  SELECT b.load, b.column_name, b.txt, b.n1, b.n2, b.k, CASE WHEN l3.own <= l3.below THEN 3 WHEN l2.own <= l2.below THEN 2 WHEN l1.own <= l1.below THEN 1 ELSE 0 END AS level
  FROM bits b JOIN l3 ON l3.load IS NOT DISTINCT FROM b.load AND l3.column_name = b.column_name
  JOIN l2 ON l2.load IS NOT DISTINCT FROM b.load AND l2.column_name = b.column_name AND l2.n2 = b.n2
  JOIN l1 ON l1.load IS NOT DISTINCT FROM b.load AND l1.column_name = b.column_name AND l1.n1 = b.n1),
chosen AS (SELECT *, CASE level WHEN 3 THEN '.*' WHEN 2 THEN n2 WHEN 1 THEN n1 ELSE txt END AS node FROM levelled)
"""
SPECIAL = r"regexp_replace(node, '([\\.\[\]{}()*+?^$|])', '\\\1', 'g')"
SQL["p5_expressions"] = rf"""
WITH {INDUCED},
e AS (SELECT c.*, CASE WHEN value_pattern IS NOT NULL AND NOT regexp_full_match(txt, value_pattern) THEN k ELSE 0 END AS bad FROM chosen c LEFT JOIN profile_baseline b USING (column_name)),
g AS (SELECT load, column_name, level, node, count(*) AS n_values, sum(k)::BIGINT AS n_rows, sum(bad)::BIGINT AS n_nonconforming FROM e GROUP BY load, column_name, level, node),
m AS (SELECT *, CASE WHEN level = 2 THEN '+' ELSE '' END AS many, {SPECIAL} AS special FROM g)
SELECT load, column_name, level, CASE WHEN level = 3 THEN '.*' WHEN level = 0 THEN special
         ELSE replace(replace(replace(translate(special, 'Aad', chr(1) || chr(2) || chr(3)), chr(1), '[A-Z]' || many), chr(2), '[a-z]' || many), chr(3), '\d' || many) END AS expression,
       n_values, n_rows, n_nonconforming FROM m
"""
SQL["p5_coverage"] = rf"""
WITH {INDUCED},
loads AS (SELECT load, column_name, lag(load) OVER (PARTITION BY column_name ORDER BY load) AS previous_load FROM (SELECT DISTINCT load, column_name FROM chosen) t),
sets AS (SELECT DISTINCT load AS previous_load, column_name, level, node FROM chosen),
hits AS (SELECT c.load, c.column_name, l.previous_load, c.txt, c.k,
  EXISTS (SELECT 1 FROM sets s WHERE s.previous_load = l.previous_load AND s.column_name = c.column_name
          AND s.node = CASE s.level WHEN 3 THEN '.*' WHEN 2 THEN c.n2 WHEN 1 THEN c.n1 ELSE c.txt END) AS hit
  FROM chosen c JOIN loads l ON l.load = c.load AND l.column_name = c.column_name WHERE l.previous_load IS NOT NULL)
SELECT load, column_name, previous_load, sum(k)::BIGINT AS n_rows, sum(CASE WHEN hit THEN k ELSE 0 END)::BIGINT AS n_covered, sum(CASE WHEN hit THEN k ELSE 0 END) / sum(k) AS coverage
FROM hits GROUP BY load, column_name, previous_load
"""

ORPHANS = """
parents AS (
  SELECT 'subjects' AS ref_table, lower(trim(subject_id)) AS ref_id, registered_at AS since, withdrawn_at AS until FROM subjects
  UNION ALL SELECT 'sessions', lower(trim(subject_id)) || chr(1) || lower(trim(session_id)), registered_at, withdrawn_at FROM sessions
  UNION ALL SELECT 'file_manifest', lower(trim(source_file)), received_at, withdrawn_at FROM file_manifest),
children AS (
  SELECT discovery_id, discovered_at AS at_, 'subjects' AS ref_table, lower(trim(subject_id)) AS ref_id, lower(trim(subject_id)) AS ref_key FROM subject_sessions
  UNION ALL SELECT discovery_id, discovered_at, 'sessions', lower(trim(subject_id)) || chr(1) || lower(trim(session_id)), lower(trim(session_id)) FROM subject_sessions
  UNION ALL SELECT DISTINCT discovery_id, at_, 'file_manifest', f, f FROM (
    SELECT discovery_id, discovered_at AS at_, lower(trim(unnest(stats_files))) AS f FROM subject_sessions) u),
verdict AS (
  SELECT c.discovery_id, c.ref_table, c.ref_key, c.at_,
         CASE WHEN count(p.ref_id) = 0 THEN 'missing'
              WHEN bool_or(p.since <= c.at_ AND coalesce(p.until > c.at_, true)) THEN NULL
              WHEN bool_or(p.since <= c.at_) THEN 'deleted' ELSE 'late' END AS state
  FROM children c LEFT JOIN parents p USING (ref_table, ref_id) WHERE c.ref_id IS NOT NULL
  GROUP BY c.discovery_id, c.ref_table, c.ref_id, c.ref_key, c.at_)
"""

SQL["p6_found"] = f"WITH {ORPHANS} SELECT discovery_id, ref_table, ref_key, state FROM verdict WHERE state IS NOT NULL"

SQL["p6_report"] = f"""
WITH {ORPHANS}
SELECT ref_table, strftime(at_, '%Y-%m') AS period, state, count(*) AS n_references, count(DISTINCT ref_key) AS n_keys
FROM verdict WHERE state IS NOT NULL GROUP BY ALL
"""

FINITE = ", ".join(
    f"CASE WHEN isfinite({c}) THEN {c} END AS {c}"
    for c in (
        "time_from_baseline_years", "field_strength_tesla", "value", "age_at_session", "age_baseline", "etiv", "etiv_baseline", "surface_holes_lh",
        "surface_holes_rh",
    )
)

#: one row per primary key: the row ingested last, the greater value on a tie
CANON = f"""
{CANONICAL},
clean AS (SELECT * REPLACE ({FINITE}, CASE WHEN region LIKE 'lh-%' THEN 'lh' WHEN region LIKE 'rh-%' THEN 'rh' ELSE hemisphere END AS hemisphere) FROM obs),
canon AS (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY dataset, subject_id, session_id, region, measure_type
          ORDER BY ingested_at DESC NULLS LAST, value DESC NULLS LAST, source_file_checksum NULLS LAST) = 1)
"""
KEY = "dataset, subject_id, session_id, region, measure_type"
COUNT = "count(*) AS n"

SQL["canonical_long"] = f"WITH {CANON} SELECT {KEY}, hemisphere, site, value, etiv, surface_holes_lh, unit, ingested_at FROM canon"
SQL["dup_keys"] = f"WITH {CANONICAL} SELECT {KEY}, {COUNT} FROM obs GROUP BY ALL HAVING count(*) > 1"
REQUIRED = (
    "dataset", "dataset_version", "subject_id", "session_id", "region", "measure_type", "source_file", "source_file_checksum", "parser_version",
    "ingested_at",
)
SQL["null_violations"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM observations" for c in REQUIRED
)
SQL["value_counts_null"] = " UNION ALL ".join(
    f"SELECT '{c}' AS field, coalesce({c}, '<null>') AS value, {COUNT} FROM observations GROUP BY ALL"
    for c in ("site", "sex", "dx_baseline", "hemisphere", "freesurfer_version")
)
SQL["sessions_per_subject"] = """
SELECT n_sessions, count(*) AS n_subjects
FROM (SELECT subject_id, count(DISTINCT session_id) AS n_sessions FROM observations GROUP BY 1) t GROUP BY 1
"""
SQL["metadata_coverage"] = f"WITH {CANON} " + " UNION ALL ".join(
    f"SELECT count(*) AS n_rows, '{c}' AS field, count({c}) AS n_present, count({c}) / count(*) AS coverage FROM canon"
    for c in ("scanner_manufacturer", "scanner_model", "field_strength_tesla", "freesurfer_version", "etiv")
)

ROSTER = """
roster AS (SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY subject_id, session_id ORDER BY registered_at, visit_index, site) = 1),
disc AS (SELECT upper(trim(subject_id)) AS subject_id, lower(trim(session_id)) AS session_id,
                list_distinct(flatten(list(coalesce(stats_files, [])))) AS files FROM subject_sessions GROUP BY ALL),
undiscovered AS (SELECT r.*, CASE WHEN missing_cause = 'missing_acquisition' THEN missing_cause ELSE 'undocumented_absence' END AS cause
                 FROM roster r ANTI JOIN disc d USING (subject_id, session_id))
"""
CLASSES = """
found AS (SELECT DISTINCT subject_id, session_id, 1 AS hit FROM observations),
classes AS (SELECT subject_id, count(*) AS expected, count(hit) AS observed,
   CASE WHEN count(hit) = 0 THEN 'absent' WHEN count(hit) = count(*) THEN 'completer' ELSE 'partial' END AS class
   FROM roster LEFT JOIN found USING (subject_id, session_id) GROUP BY 1)
"""
SQL["expected_vs_found"] = f"WITH {ROSTER}, {CLASSES} SELECT * FROM classes"
SQL["missing_by_site"] = f"WITH {ROSTER} SELECT coalesce(site, 'unknown') AS \"group\", cause, {COUNT} FROM undiscovered GROUP BY ALL"
SQL["missing_by_time"] = f"WITH {ROSTER} SELECT coalesce(visit_index::VARCHAR, 'unknown') AS \"group\", cause, {COUNT} FROM undiscovered GROUP BY ALL"

LOST_REGIONS = """
present AS (SELECT DISTINCT subject_id, session_id, region FROM canon WHERE region IN (SELECT region FROM region_set)),
producing AS (SELECT DISTINCT subject_id, session_id FROM present),
lost AS (SELECT p.subject_id, p.session_id, v.region,
  CASE WHEN d.files IS NULL THEN 'observation_loss_cause_unavailable'
       WHEN list_contains(list_transform(d.files, lambda f: lower(regexp_extract(f, '[^/]*$'))),
            CASE WHEN v.measure_type = 'volume' THEN 'aseg.stats' ELSE v.hemisphere || '.aparc.stats' END) THEN 'absent_from_source'
       ELSE 'source_unavailable' END AS cause
  FROM producing p CROSS JOIN region_set v ANTI JOIN present q ON q.subject_id = p.subject_id AND q.session_id = p.session_id AND q.region = v.region
  LEFT JOIN disc d ON d.subject_id = p.subject_id AND d.session_id = p.session_id)
"""
SQL["region_loss_causes"] = f"WITH {CANON}, {ROSTER}, {LOST_REGIONS} SELECT region, cause, {COUNT} FROM lost GROUP BY ALL"

BASE_ORDER = "(time_from_baseline_years, session_id, region, measure_type)"
CODED = """
coded AS (SELECT * REPLACE (CASE WHEN lower(trim(sex)) IN ('f', 'female', '2') THEN 'F' WHEN lower(trim(sex)) IN ('m', 'male', '1') THEN 'M' END AS sex)
          FROM canon)
"""


def _first(columns: tuple[str, ...], source: str) -> str:
    order = "time_from_baseline_years NULLS FIRST, session_id, region, measure_type"
    firsts = ", ".join(f"first({c} ORDER BY {order}) FILTER ({c} IS NOT NULL) AS {c}" for c in columns)
    return f"base AS (SELECT subject_id, {firsts} FROM {source} GROUP BY 1)"


SQL["baseline_first"] = f"WITH {CANON}, {_first(('site', 'age_baseline', 'sex', 'dx_baseline', 'etiv_baseline'), 'canon')} SELECT * FROM base"
COMPLETERS = f"""
{CANON}, {CODED}, {ROSTER}, {CLASSES}, {_first(("age_baseline", "sex", "dx_baseline", "etiv_baseline"), "coded")},
members AS (SELECT base.*, class FROM base JOIN classes USING (subject_id)),
long AS (SELECT class, 'age_baseline' AS field, age_baseline AS x FROM members UNION ALL SELECT class, 'etiv_baseline', etiv_baseline FROM members),
summary AS (SELECT class, field, count(x) AS n, avg(x) AS mean, CASE WHEN count(x) = 1 THEN 0 ELSE stddev_samp(x) END AS sd
            FROM long WHERE x IS NOT NULL GROUP BY ALL)
"""
SQL["completer_smd"] = f"""
WITH {COMPLETERS},
s AS (SELECT coalesce(a.field, b.field) AS field, a.n AS n_a, b.n AS n_b, (a.mean - b.mean) / nullif(sqrt((a.sd * a.sd + b.sd * b.sd) / 2), 0) AS smd
      FROM (SELECT * FROM summary WHERE class = 'completer') a FULL JOIN (SELECT * FROM summary WHERE class = 'partial') b ON a.field = b.field)
SELECT *, coalesce(abs(smd) >= 0.1, false) AS notable FROM s
"""
SQL["category_share"] = f"""
WITH {COMPLETERS}
SELECT class, sex AS level, {COUNT}, count(*) / sum(count(*)) OVER (PARTITION BY class) AS share FROM members WHERE sex IS NOT NULL GROUP BY 1, 2
"""
SQL["batch_sizes"] = f"""
WITH {CANON} SELECT site AS batch, count(*) AS n_observations, count(DISTINCT subject_id) AS n_subjects, count(DISTINCT subject_id) < 60 AS small
FROM canon WHERE site IS NOT NULL GROUP BY 1
"""
SQL["small_batch_composition"] = f"""
WITH {CANON}, {CODED},
s AS (SELECT * FROM coded WHERE site IS NOT NULL QUALIFY row_number() OVER (PARTITION BY site, subject_id
      ORDER BY time_from_baseline_years NULLS FIRST, session_id, region) = 1)
SELECT site AS batch, count(*) AS n_subjects, count(*) FILTER (sex = 'F') AS n_female, count(*) FILTER (sex = 'M') AS n_male,
       count(*) FILTER (dx_baseline = 'patient') AS n_patient, count(*) FILTER (dx_baseline = 'control') AS n_control,
       avg(age_baseline) AS age_mean, stddev_samp(age_baseline) AS age_sd
FROM s GROUP BY 1 HAVING count(*) < 60
"""

QUALITY = """
zc AS (SELECT site, region, measure_type, median(value) AS c FROM canon GROUP BY ALL),
zm AS (SELECT k.site, k.region, k.measure_type, any_value(c) AS c, median(abs(value - c)) AS m FROM canon k
       JOIN zc ON k.site IS NOT DISTINCT FROM zc.site AND k.region = zc.region AND k.measure_type = zc.measure_type GROUP BY ALL),
scored AS (SELECT k.*, CASE WHEN m IS NULL OR m = 0 THEN 0 ELSE (value - c) / (1.4826 * m) END AS z FROM canon k
           JOIN zm ON k.site IS NOT DISTINCT FROM zm.site AND k.region = zm.region AND k.measure_type = zm.measure_type),
sess AS (SELECT dataset, subject_id, session_id, max(site) AS site, max(etiv) AS etiv,
                least(2 - 2 * max(surface_holes_lh), 2 - 2 * max(surface_holes_rh)) AS euler FROM canon GROUP BY ALL),
ec AS (SELECT site, median(euler) AS c FROM sess GROUP BY 1),
em AS (SELECT s.site, any_value(c) AS c, median(abs(euler - c)) AS m FROM sess s JOIN ec ON s.site IS NOT DISTINCT FROM ec.site GROUP BY 1),
sflags AS (SELECT s.*, CASE WHEN euler IS NULL THEN NULL WHEN m IS NULL OR m = 0 THEN 0 ELSE (euler - c) / (1.4826 * m) END AS euler_z,
                  coalesce(etiv < 1.1e6 OR etiv > 1.9e6, false) AS etiv_implausible
           FROM sess s JOIN em ON s.site IS NOT DISTINCT FROM em.site),
sflag AS (SELECT *, coalesce(euler < -40 OR euler_z < -4, false) AS euler_low FROM sflags),
sided AS (SELECT *, CASE WHEN region LIKE hemisphere || '-%' THEN substr(region, length(hemisphere) + 2) ELSE region END AS structure FROM scored),
pairs AS (SELECT dataset, subject_id, session_id, structure, measure_type, max(site) AS site, max(value) FILTER (hemisphere = 'lh') AS lh,
                 max(value) FILTER (hemisphere = 'rh') AS rh FROM sided WHERE hemisphere IN ('lh', 'rh') GROUP BY ALL HAVING lh IS NOT NULL AND rh IS NOT NULL),
ai AS (SELECT *, (lh - rh) / nullif((lh + rh) / 2, 0) AS asymmetry FROM pairs),
ac AS (SELECT site, structure, measure_type, median(asymmetry) AS c FROM ai GROUP BY ALL),
am AS (SELECT a.site, a.structure, a.measure_type, any_value(c) AS c, median(abs(asymmetry - c)) AS m FROM ai a
       JOIN ac ON a.site IS NOT DISTINCT FROM ac.site AND a.structure = ac.structure AND a.measure_type = ac.measure_type GROUP BY ALL),
asym AS (SELECT a.*, CASE WHEN m IS NULL OR m = 0 THEN 0 ELSE (asymmetry - c) / (1.4826 * m) END AS asymmetry_z FROM ai a
         JOIN am ON a.site IS NOT DISTINCT FROM am.site AND a.structure = am.structure AND a.measure_type = am.measure_type),
qflags AS (SELECT s.*, f.etiv_implausible, f.euler_low, coalesce(abs(z) > 4, false) AS region_outlier,
                  coalesce(abs(a.asymmetry_z) > 4, false) AS asymmetry_outlier
           FROM sided s JOIN sflag f USING (dataset, subject_id, session_id) LEFT JOIN asym a USING (dataset, subject_id, session_id, structure, measure_type)),
qc AS (SELECT * EXCLUDE (qc_status, qc_flags, qc_score, qc_notes, analysis_included),
  CASE WHEN etiv_implausible THEN 'FAIL' WHEN euler_low OR region_outlier OR asymmetry_outlier THEN 'WARNING' ELSE 'PASS' END AS qc_status,
  list_filter([CASE WHEN etiv_implausible THEN 'etiv_implausible' END, CASE WHEN euler_low THEN 'euler_low' END,
               CASE WHEN region_outlier THEN 'region_outlier' END, CASE WHEN asymmetry_outlier THEN 'asymmetry_outlier' END], lambda x: x IS NOT NULL) AS flags
  FROM qflags)
"""
SQL["robust_z"] = f"WITH {CANON}, {QUALITY} SELECT {KEY}, round(z, 6) AS z FROM scored"
SQL["etiv_euler_flags"] = f"""
WITH {CANON}, {QUALITY} SELECT subject_id, session_id, site, euler, round(euler_z, 6) AS euler_z, etiv_implausible, euler_low FROM sflag
"""
SQL["asymmetry_flags"] = f"""
WITH {CANON}, {QUALITY} SELECT subject_id, session_id, structure, measure_type, round(asymmetry, 8) AS asymmetry, round(asymmetry_z, 6) AS asymmetry_z,
  coalesce(abs(asymmetry_z) > 4, false) AS asymmetry_outlier FROM asym
"""
SQL["qc_flags"] = f"""
WITH {CANON}, {QUALITY} SELECT {KEY}, qc_status, array_to_string(flags, '; ') AS flags, round(abs(z), 6) AS qc_score,
  CASE WHEN len(flags) = 0 THEN 'no QC flag triggered' ELSE array_to_string(flags, '; ') END AS qc_notes, qc_status = 'PASS' AS analysis_included FROM qc
"""
SQL["qc_flag_counts"] = f"WITH {CANON}, {QUALITY} SELECT flag, {COUNT} FROM (SELECT unnest(flags) AS flag FROM qc) t GROUP BY 1"
SQL["qc_status_by_site"] = f"""
WITH {CANON}, {QUALITY} SELECT site, qc_status, {COUNT}, count(DISTINCT (subject_id, session_id)) AS n_sessions FROM qc GROUP BY ALL
"""
SQL["inclusion_policy"] = f"""
WITH {CANON}, {QUALITY} SELECT measure_type, count(*) FILTER (qc_status IN ('PASS', 'WARNING')) AS n_included,
  count(*) FILTER (qc_status = 'PASS') AS n_pass, {COUNT} FROM qc GROUP BY 1
"""
SQL["qc_confusion"] = f"""
WITH {CANON}, {QUALITY},
truth AS (SELECT subject_id, session_id, bool_or(coalesce(surface_holes_lh < 0 OR surface_holes_lh > 80 OR etiv < 6e5 OR etiv > 2.5e6, false)) AS bad
          FROM observations GROUP BY ALL),
j AS (SELECT (etiv_implausible OR euler_low) AS p, coalesce(bad, false) AS t FROM sflag LEFT JOIN truth USING (subject_id, session_id)),
c AS (SELECT count(*) FILTER (p AND t) AS tp, count(*) FILTER (p AND NOT t) AS fp, count(*) FILTER (NOT p AND t) AS fn, count(*) FILTER (NOT p AND NOT t) AS tn FROM j)
SELECT *, tp / nullif(tp + fn, 0) AS recall, fp / nullif(fp + tn, 0) AS false_positive_rate, tp / nullif(tp + fp, 0) AS precision FROM c
"""

KNOWN_TIME = "FROM canon WHERE site IS NOT NULL AND time_from_baseline_years IS NOT NULL"
SQL["time_crosstab"] = f"""
WITH {CANON},
r AS (SELECT min(time_from_baseline_years) AS lo, max(time_from_baseline_years) AS hi {KNOWN_TIME}),
b AS (SELECT site, CASE WHEN time_from_baseline_years <= lo + (hi - lo) / 4 THEN 0 WHEN time_from_baseline_years <= lo + (hi - lo) * 2 / 4 THEN 1
        WHEN time_from_baseline_years <= lo + (hi - lo) * 3 / 4 THEN 2 ELSE 3 END AS bin FROM canon, r WHERE site IS NOT NULL AND time_from_baseline_years IS NOT NULL)
SELECT site AS batch, count(*) FILTER (bin = 0) AS bin_0, count(*) FILTER (bin = 1) AS bin_1, count(*) FILTER (bin = 2) AS bin_2, count(*) FILTER (bin = 3) AS bin_3
FROM b GROUP BY 1
"""
SQL["confound_r2"] = f"""
WITH {CANON},
rows_ AS (SELECT 'site' AS batch_column, site AS b, time_from_baseline_years AS t FROM canon
          UNION ALL SELECT 'era', CASE WHEN time_from_baseline_years >= 0.5 THEN 'late' ELSE site END, time_from_baseline_years FROM canon),
known AS (SELECT *, dense_rank() OVER (PARTITION BY batch_column ORDER BY b) AS code, avg(t) OVER (PARTITION BY batch_column, b) AS m,
                 avg(t) OVER (PARTITION BY batch_column) AS g FROM rows_ WHERE b IS NOT NULL AND t IS NOT NULL),
s AS (SELECT batch_column, count(DISTINCT b) AS n_batches, sum((m - g) * (m - g)) / nullif(sum((t - g) * (t - g)), 0) AS r2, coalesce(corr(code, t), 0) AS r FROM known GROUP BY 1)
SELECT batch_column, n_batches, round(r2, 8) AS r2, round(r, 8) AS correlation, severity, severity IN ('none', 'mild') AS interpretable FROM (
  SELECT *, CASE WHEN n_batches < 2 THEN 'not_assessable' WHEN r2 IS NULL THEN 'unknown' WHEN r2 >= 0.5 THEN 'severe' WHEN r2 >= 0.2 THEN 'moderate'
    WHEN r2 >= 0.05 THEN 'mild' ELSE 'none' END AS severity FROM s) t
"""
SQL["pool_signature"] = f"""
WITH {CANON},
small AS (SELECT site FROM canon WHERE site IS NOT NULL GROUP BY 1 HAVING count(DISTINCT subject_id) < 150),
f AS (SELECT site AS batch, coalesce(scanner_manufacturer, '?') || '/' || coalesce(scanner_model, '?') || '/' || coalesce(field_strength_tesla::VARCHAR, '?') AS signature
      FROM canon WHERE site IN (SELECT site FROM small) QUALIFY row_number() OVER (PARTITION BY site ORDER BY subject_id, session_id, region, measure_type) = 1),
g AS (SELECT signature, count(*) AS k, string_agg(batch, '+' ORDER BY batch) AS members FROM f GROUP BY 1)
SELECT batch, signature, CASE WHEN k > 1 THEN 'pool:' || members END AS pool FROM f JOIN g USING (signature)
"""
SQL["batch_policy_mask"] = f"""
WITH {CANON}, big AS (SELECT site FROM canon WHERE site IS NOT NULL GROUP BY 1 HAVING count(DISTINCT subject_id) >= 60)
SELECT site AS batch, coalesce(site IN (SELECT site FROM big), false) AS estimable, {COUNT} FROM canon GROUP BY ALL
"""

MODELED = f"""
{CANON}, {CODED}, modeled AS (SELECT * FROM coded WHERE measure_type IN ('volume', 'thickness')),
enough AS (SELECT site FROM modeled WHERE site IS NOT NULL GROUP BY 1 HAVING count(DISTINCT subject_id) >= 20),
mom AS (SELECT region, measure_type, site AS batch, {COUNT}, avg(value) AS y, var_pop(value) AS yy FROM modeled
        WHERE value IS NOT NULL AND site IN (SELECT site FROM enough) GROUP BY ALL),
feat AS (SELECT region, measure_type, sum(n * y) / sum(n) AS grand, sqrt(sum(n * yy) / sum(n)) AS sigma FROM mom WHERE n >= 2 GROUP BY ALL),
par AS (SELECT mom.*, grand, sigma, (y - grand) / sigma AS gamma, yy * n / (n - 1) / (sigma * sigma) AS delta FROM mom JOIN feat USING (region, measure_type) WHERE n >= 2)
"""
SQL["combat_moments"] = f"WITH {MODELED} SELECT region, measure_type, batch, n, round(y, 8) AS mean, round(yy, 8) AS variance FROM mom"
SQL["combat_no_eb"] = f"""
WITH {MODELED} SELECT region, measure_type, batch, n, round(grand, 6) AS grand, round(sigma, 6) AS sigma, round(gamma, 6) AS gamma, round(delta, 6) AS delta FROM par
"""
SQL["combat_priors"] = f"""
WITH {MODELED} SELECT batch, count(*) AS n_features, round(avg(gamma), 6) AS gamma_mean, round(var_samp(gamma), 6) AS gamma_var,
  round(avg(delta), 6) AS delta_mean, round(var_samp(delta), 6) AS delta_var FROM par GROUP BY 1
"""
SQL["ols_slope_by_region"] = f"""
WITH {MODELED} SELECT region, measure_type, {COUNT}, round(regr_slope(value, time_from_baseline_years), 6) AS slope,
  round(regr_intercept(value, time_from_baseline_years), 4) AS intercept
FROM modeled WHERE value IS NOT NULL AND time_from_baseline_years IS NOT NULL GROUP BY ALL
"""
SQL["bh_fdr"] = f"""
WITH {MODELED},
v AS (SELECT *, substr(region, 4) AS structure FROM modeled WHERE value IS NOT NULL AND site IS NOT NULL AND hemisphere IN ('lh', 'rh')),
w AS (SELECT region, measure_type, avg(value) AS gm, stddev_pop(value) AS sd FROM v GROUP BY ALL),
t AS (SELECT v.structure, v.region, v.measure_type, site, (avg(value) - any_value(gm)) / (any_value(sd) / sqrt(count(*))) AS z
      FROM v JOIN w ON v.region = w.region AND v.measure_type = w.measure_type GROUP BY ALL),
p AS (SELECT structure, measure_type, site, round(exp(-sum(z * z) / 2), 9) AS p_value FROM t GROUP BY ALL HAVING count(*) = 2),
r AS (SELECT *, p_value * count(*) OVER (PARTITION BY structure, measure_type) / count(*) OVER (PARTITION BY structure, measure_type ORDER BY p_value) AS raw FROM p)
SELECT structure, measure_type, site, p_value, round(least(1, min(raw) OVER (PARTITION BY structure, measure_type ORDER BY p_value DESC)), 8) AS q_value FROM r
"""
SQL["model_exclusions"] = f"""
WITH {CANON}, {QUALITY},
q AS (SELECT *, CASE WHEN lower(trim(sex)) IN ('f', 'female', '2') THEN 'F' WHEN lower(trim(sex)) IN ('m', 'male', '1') THEN 'M' END AS s FROM qc WHERE qc_status = 'PASS'),
c AS (SELECT *, coalesce(value IS NOT NULL AND time_from_baseline_years IS NOT NULL AND age_baseline IS NOT NULL AND s IS NOT NULL
        AND dx_baseline IN ('patient', 'control') AND etiv_baseline IS NOT NULL, false) AS complete FROM q),
f AS (SELECT region, measure_type, count(DISTINCT subject_id) >= 3 AS estimable FROM c WHERE complete AND measure_type IN ('volume', 'thickness') GROUP BY ALL),
e AS (SELECT CASE WHEN estimable IS NULL THEN 'outside_modeled_region_set' WHEN NOT estimable THEN 'design_not_identifiable'
             WHEN NOT complete THEN 'incomplete_model_covariates' END AS cause FROM c LEFT JOIN f USING (region, measure_type))
SELECT cause, {COUNT} FROM e WHERE cause IS NOT NULL GROUP BY 1
"""
SQL["funnel"] = f"""
WITH {CANON}, {QUALITY}, {ROSTER},
expected AS (SELECT d.* FROM disc d SEMI JOIN roster USING (subject_id, session_id)),
judged AS (SELECT q.* FROM qc q SEMI JOIN region_set USING (region, measure_type) SEMI JOIN expected USING (subject_id, session_id)),
present AS (SELECT DISTINCT subject_id, session_id, region FROM judged),
producing AS (SELECT DISTINCT subject_id, session_id FROM judged),
lost4 AS (SELECT CASE WHEN list_contains(list_transform(d.files, lambda f: lower(regexp_extract(f, '[^/]*$'))),
            CASE WHEN v.measure_type = 'volume' THEN 'aseg.stats' ELSE v.hemisphere || '.aparc.stats' END) THEN 'absent_from_source' ELSE 'source_unavailable' END AS cause
  FROM producing p CROSS JOIN region_set v ANTI JOIN present q ON q.subject_id = p.subject_id AND q.session_id = p.session_id AND q.region = v.region
  JOIN disc d ON d.subject_id = p.subject_id AND d.session_id = p.session_id),
losses AS (
  SELECT 2 AS i, cause FROM undiscovered UNION ALL
  SELECT 3, CASE WHEN len(files) = 0 THEN 'missing_derivative' ELSE 'no_recognised_regions' END FROM expected ANTI JOIN producing USING (subject_id, session_id) UNION ALL
  SELECT 4, cause FROM lost4 UNION ALL SELECT 5, 'excluded_qc' FROM judged WHERE qc_status <> 'PASS'),
causes AS (SELECT i, sum(k) AS lost, string_agg(cause || '=' || k, '; ' ORDER BY cause || '=' || k) AS causes FROM (SELECT i, cause, count(*) AS k FROM losses GROUP BY ALL) t GROUP BY 1),
steps AS (
  SELECT 1 AS i, 'expected sessions' AS boundary, 'sessions' AS unit, count(*) AS "count" FROM roster UNION ALL
  SELECT 2, 'discovered sessions', 'sessions', count(*) FROM expected UNION ALL
  SELECT 3, 'sessions with observations', 'sessions', count(*) FROM producing UNION ALL
  SELECT 4, 'canonical observations', 'observations', count(*) FROM judged UNION ALL
  SELECT 5, 'QC-passing observations', 'observations', count(*) FROM judged WHERE qc_status = 'PASS')
SELECT boundary, unit, "count", coalesce(lost, 0)::BIGINT AS lost, coalesce(causes, '') AS causes FROM steps LEFT JOIN causes USING (i)
"""
SQL["merge_counters"] = f"SELECT 'rows_by_measure' AS metric, lower(trim(measure_type)) AS key, {COUNT} FROM observations GROUP BY ALL"
SQL["checksum"] = "SELECT file_id, sha256(content) AS checksum, strlen(content)::BIGINT AS size_bytes FROM raw_stats"
SQL["header_kv"] = f"WITH {LINES}, {HEADERS} SELECT file_id, n AS line_number, key, value FROM h"
SQL["file_versions"] = rf"""
WITH {LINES}, {HEADERS}
SELECT value AS declaration, nullif(regexp_extract(value, '^(\d+(?:\.\d+)*)', 1), '') AS version, count(*) AS n_files FROM h WHERE key = 'cvs_version' GROUP BY ALL
"""
FATAL = "('EMPTY_FILE', 'NO_COLHEADERS', 'NO_DATA_ROWS', 'TRUNCATED_ROW', 'COLUMN_COUNT_MISMATCH')"
VERDICTS = f"""
{LINES},
bad AS (SELECT file_id, code, 0 AS n FROM whole WHERE code IS NOT NULL UNION ALL SELECT file_id, code, n FROM c WHERE code IN {FATAL}),
verdicts AS (SELECT file_id, arg_min(code, n) AS failure_code, min(n)::BIGINT AS line_number FROM bad GROUP BY 1)
"""
SQL["parse_failures"] = f"WITH {VERDICTS} SELECT * FROM verdicts"
SQL["parsed_rows"] = rf"""
WITH {VERDICTS},
v AS (SELECT c.file_id, r.source_file, list_zip(cols, fields) AS z FROM c JOIN raw_stats r USING (file_id) ANTI JOIN verdicts USING (file_id) WHERE kind = 'row' AND code IS NULL),
e AS (SELECT file_id, source_file, regexp_matches(source_file, 'aseg[^/]*$') AS sub, nullif(regexp_extract(source_file, '(lh|rh)\.[^/]*$', 1), '') AS side,
             replace(replace(lower(trim(list_filter(z, lambda x: x[1] = 'StructName')[1][2])), '_', '-'), ' ', '-') AS alias, unnest(z) AS x FROM v),
names AS (SELECT DISTINCT replace(lower(trim(a)), '_', '-') AS alias, side, canon FROM (
    SELECT unnest(list_prepend(region, source_names)) AS a, '' AS side, region AS canon FROM region_set UNION ALL SELECT structure, hemisphere, region FROM region_set) t)
SELECT e.file_id, e.source_file, s.region, s.hemisphere, s.measure_type, s.unit, replace(x[2], ',', '.')::DOUBLE AS value
FROM e JOIN names ON names.alias = e.alias AND names.side = CASE WHEN sub THEN '' ELSE e.side END JOIN region_set s ON s.region = canon
WHERE x[1] = CASE WHEN sub THEN 'Volume_mm3' ELSE 'ThickAvg' END AND s.measure_type = CASE WHEN sub THEN 'volume' ELSE 'thickness' END
"""
SQL["wide_to_long"] = f"""
WITH {CANON},
v AS (SELECT subject_id || '|' || session_id AS subject_id, region, value FROM canon WHERE measure_type = 'volume'),
k AS (SELECT DISTINCT subject_id FROM v),
r AS (SELECT region FROM region_set WHERE measure_type = 'volume')
SELECT k.subject_id, r.region AS source_name, r.region, 'volume' AS measure_type, 'mm^3' AS unit, max(v.value) AS value
FROM k CROSS JOIN r LEFT JOIN v ON v.subject_id = k.subject_id AND v.region = r.region GROUP BY ALL
"""
