"""Attribute-value rows into one wide row per entity, by characteristic sets.

Entities with exactly the same set of attributes share a signature, and each signature's table is dense: its entities keep
their values in the order of the signature's attributes, without gaps. A signature's row says at which place of them a
column's value stands. Signatures of the same measures are a class with columns of its own, and
`unionByName(allowMissingColumns=True)` unites the classes; so any number of signatures costs one scan per class.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux.operators.vocab import with_canonical_names
from strataflux.session import materialize

ENTITY = ["subject_id", "session_id"]


def cells_of(observations: DataFrame, region_set: DataFrame) -> DataFrame:
    """(subject_id, session_id, region, measure_type, value, ingested_at) with canonical names."""
    rows = observations.select(*ENTITY, "region", "hemisphere", "measure_type", "value", "ingested_at")
    return with_canonical_names(rows, region_set).drop("hemisphere")


def column_names(keys: Iterable[str]) -> dict[str, str]:
    """Column name per attribute key (JSON of region and measure_type); names that would clash, also by
    letter case only, are numbered in the order of the keys."""
    names, taken = {}, set()
    for key in sorted(keys):
        attribute = json.loads(key)
        base = "__".join(attribute.get(part, "unknown") for part in ("region", "measure_type")).replace("-", "_").replace(".", "_")
        name, n = base, 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names[key] = name
    return names


def attributes_of(observations: DataFrame, region_set: DataFrame) -> DataFrame:
    """(region, measure_type) of every attribute, from the different spellings of region, hemisphere and measure."""
    spelled = observations.select("region", "hemisphere", "measure_type").distinct()
    return with_canonical_names(spelled, region_set).select("region", "measure_type").distinct()


def _attribute_id() -> F.Column:
    return F.xxhash64(F.to_json(F.struct("region", "measure_type")))


def widen(cells: DataFrame, classes: int = 8, max_attributes: int = 5_000, attributes: DataFrame | None = None) -> DataFrame:
    """One row per (subject_id, session_id): a double column `<region>__<measure>` per attribute found,
    `signature` (hash of the attribute set), `n_attributes` and `conflicts`, the cells for which the rows
    give two or more different values.

    A cell's value is that of the row ingested last, the greater one on a tie; null and NaN values are
    no values, but a row with one still makes the attribute part of the entity. Rows that repeat a cell
    with the same value change nothing. Null entity ids form an entity of their own, null regions or
    measures become the attribute `unknown`. Attributes whose column names would be the same (`a-b` and `a.b`)
    stay apart: the later ones get `_2`, `_3` and so on. An empty input gives an empty table without attribute
    columns; extra columns are ignored. Every signature has its own dense table; `classes` only says into how many
    groups of like measures the signatures fall, of which each has its own columns. More than `max_attributes`
    attributes raise an error, since the result could not be a table of columns. `attributes` may give the
    (region, measure_type) rows that occur, if they can be had for less than a pass over the cells.
    """
    known = (cells if attributes is None else attributes).select("region", "measure_type").distinct()
    found = known.select(F.to_json(F.struct("region", "measure_type")).alias("key"), "region", "measure_type", _attribute_id().alias("a")).limit(max_attributes + 1).collect()
    if len(found) > max_attributes or len({r.a for r in found}) < len(found):
        raise ValueError(f"more than {max_attributes} attributes: not a table of columns")
    columns = column_names(r.key for r in found)
    by_id = {r.a: r for r in found}

    sound = F.when(F.col("value").isNotNull() & ~F.isnan("value"), F.col("value").cast("double"))
    resolved = (
        cells.select(*ENTITY, _attribute_id().alias("a"), "ingested_at", sound.alias("v"))
        .groupBy(*ENTITY, "a")
        .agg(
            F.max(F.when(F.col("v").isNotNull(), F.struct("ingested_at", "v"))).getField("v").alias("value"),
            F.coalesce(F.max("v") != F.min("v"), F.lit(False)).alias("conflict"),
        )
    )
    packed = materialize(
        resolved.groupBy(*ENTITY)
        .agg(F.array_sort(F.collect_list(F.struct("a", "value", "conflict"))).alias("cells"))
        .select(
            *ENTITY, F.xxhash64("cells.a").alias("signature"), F.col("cells.a").alias("set"), F.col("cells.value").alias("values"),
            F.filter(F.sequence(F.lit(0), F.size("cells") - 1), lambda i: F.get("cells", i)["conflict"]).alias("contradicted"),
        ),
        "packed",
    )

    # one row per signature: its attributes in the order in which every entity of it keeps its values
    measure = F.create_map(*[F.lit(x) for r in found for x in (r.a, str(r.measure_type))]) if found else None
    kinds = F.array_sort(F.array_distinct(F.transform("set", lambda a: measure[a]))) if found else F.array()
    signatures = materialize(
        packed.groupBy("signature").agg(F.first("set").alias("set")).withColumn("class", F.pmod(F.xxhash64(kinds), F.lit(classes)).cast("int")), "signatures"
    )
    members = {r["class"]: r["all"] for r in signatures.select("class", F.explode("set").alias("a")).groupBy("class").agg(F.collect_set("a").alias("all")).collect()}
    attribute = F.create_map(*[x for r in found for x in (F.lit(r.a), F.struct(F.lit(r.region).cast("string").alias("region"), F.lit(r.measure_type).cast("string").alias("measure_type")))]) if found else None
    head = [*ENTITY, "signature", "n_attributes", "conflicts"]
    wide = None
    for number, own in sorted(members.items()):
        ordered = sorted(own, key=lambda a: columns[by_id[a].key])
        place = {a: i for i, a in enumerate(ordered)}
        # `places` has, for each column of the class, where the signature's entities keep its value; absent ones lie outside
        places = F.transform(F.array(*[F.lit(a) for a in ordered]), lambda a: F.array_position("set", a).cast("int") - 1)
        own_signatures = signatures.filter(F.col("class") == number).select("signature", places.alias("places"), F.transform("set", lambda a: attribute[a]).alias("named"))
        dense = packed.drop("set").join(own_signatures, "signature").select(
            *ENTITY, "signature", F.size("values").alias("n_attributes"), F.transform("contradicted", lambda i: F.get("named", i)).alias("conflicts"),
            *[F.get("values", F.col("places")[i]).alias(columns[by_id[a].key]) for a, i in place.items()],
        )
        wide = dense if wide is None else wide.unionByName(dense, allowMissingColumns=True)
    if wide is None:
        nothing = "array<struct<region:string,measure_type:string>>"
        return packed.select(*ENTITY, "signature", F.lit(0).alias("n_attributes"), F.array().cast(nothing).alias("conflicts"))
    return wide.select(*head, *sorted(c for c in wide.columns if c not in head))


def conflicting_cells(wide: DataFrame) -> DataFrame:
    """(subject_id, session_id, region, measure_type) of the wide table's contradicting cells."""
    return wide.select(*ENTITY, F.explode("conflicts").alias("a")).select(*ENTITY, "a.region", "a.measure_type")
