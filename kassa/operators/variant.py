"""Flattening of JSON whose fields aren't known beforehand.

``nested.flatten`` follows a declared schema, so what the schema doesn't name is
lost. Here each text is parsed into a VARIANT and opened by what it holds: the
fields of an object become ``A_B_C`` paths, an array becomes a row per element
(several arrays multiply rows, an empty one keeps its row with a NULL value, an
empty object is a NULL value too). A field may be an object in one record, an
array in the next and a number in a third.

A row carries the list of its (path, value) pairs. One step opens all objects
on the top level of the values and one array; rows without nested values are
done, the others go on. After every few steps the rows are written, so the plan
stays small and each level reads only what is still nested. The number of
rounds follows the depth of the deepest record, not their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kassa.operators.nested import CORRUPT
from kassa.session import materialize

STEPS = 3  # between two writes
TODO, ITEMS, FIELDS = "_todo", "items", "fields"


def _kind(value: Column) -> Column:
    """OBJECT<..>, ARRAY<..>, VOID or a scalar type."""
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _is(value: Column, kind: str) -> Column:
    return _kind(value).startswith(kind + "<")


def _nested(value: Column) -> Column:
    return _is(value, "OBJECT") | _is(value, "ARRAY")


def _pair(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"))


def _open_objects(todo: Column, sep: str) -> Column:
    def opened(e: Column) -> Column:
        inside = F.map_entries(F.try_variant_get(e["value"], "$", "map<string,variant>"))
        below = lambda key: F.when(e["path"] == "", key).otherwise(F.concat(e["path"], F.lit(sep), key))
        return (F.when(~_is(e["value"], "OBJECT"), F.array(e))
                .when(F.size(inside) > 0, F.transform(inside, lambda x: _pair(below(x["key"]), x["value"])))
                .otherwise(F.array(_pair(e["path"], F.lit(None).cast("variant")))))
    return F.flatten(F.transform(todo, opened))


def _step(df: DataFrame, carry: list[str], sep: str) -> DataFrame:
    """Objects opened, then the first array: a row per element."""
    df = df.select(*carry, ITEMS, _open_objects(F.col(TODO), sep).alias(TODO))
    df = df.select("*", F.array_position(F.transform(TODO, lambda e: _is(e["value"], "ARRAY")), True).alias("_first"))
    elements = F.try_variant_get(F.get(TODO, F.col("_first") - 1)["value"], "$", "array<variant>")
    df = df.select("*", F.posexplode_outer(F.when(F.col("_first") > 0, elements)).alias("_at", "_element"))
    here = F.col("_first") > 0
    chosen = F.transform(TODO, lambda e, i: F.when(i == F.col("_first") - 1, _pair(e["path"], F.col("_element"))).otherwise(e))
    return df.select(*carry, F.when(here, F.concat(ITEMS, F.array(F.coalesce("_at", F.lit(-1))))).otherwise(F.col(ITEMS)).alias(ITEMS),
                     F.when(here, chosen).otherwise(F.col(TODO)).alias(TODO))


def flatten_variant(df: DataFrame, column: str, sep: str = "_") -> DataFrame:
    """The rows of ``df`` without ``column``, one for each combination of array
    elements, with ``items`` (the element numbers chosen, in the order in which
    the arrays were opened; -1 for an empty array), ``fields`` (path, value as
    text, type; a JSON null has type VOID) and ``_corrupt_record``: a text that
    isn't JSON, which has no fields. A NULL text counts as the empty one."""
    carry = [f"`{c}`" for c in df.columns if c != column]
    text, value = F.coalesce(F.col(column), F.lit("")), F.try_parse_json(F.col(column))
    start = materialize(df.select(
        *carry, F.when(value.isNull(), text).alias(CORRUPT), F.array().cast("array<int>").alias(ITEMS),
        F.array(_pair(F.lit(""), value)).alias(TODO)), "variants")
    carry.append(CORRUPT)
    rows, done = start, []
    while True:
        for _ in range(STEPS):
            rows = _step(rows, carry, sep)
        level = materialize(rows.withColumn("_open", F.exists(TODO, lambda e: _nested(e["value"]))), "variant-level")
        done.append(level.where("NOT _open"))
        rows = level.where("_open").drop("_open")
        if rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    fields = F.transform(TODO, lambda e: F.struct(
        e["path"].alias("path"), F.try_variant_get(e["value"], "$", "string").alias("value"), _kind(e["value"]).alias("type")))
    return out.select(*carry, ITEMS, F.when(F.col(CORRUPT).isNull(), fields).alias(FIELDS))


def known_columns(flat: DataFrame, names: list[str]) -> DataFrame:
    """A text column for each of ``names`` (paths; of repeated ones the first)
    and ``rest``: the (path, value, type) of all other fields, so that none is
    lost."""
    value = lambda name: F.get(F.filter(FIELDS, lambda f: f["path"] == name), F.lit(0))["value"]
    return flat.select(*[f"`{c}`" for c in flat.columns if c != FIELDS], *[value(n).alias(n) for n in names],
                       F.filter(FIELDS, lambda f: ~f["path"].isin(names)).alias("rest"))


def long_fields(flat: DataFrame) -> DataFrame:
    """A row per field: path, value, type; a row without fields stays."""
    return flat.select(*[f"`{c}`" for c in flat.columns if c != FIELDS], F.explode_outer(FIELDS).alias("_f")).select(
        *[f"`{c}`" for c in flat.columns if c != FIELDS], "_f.path", "_f.value", "_f.type")
