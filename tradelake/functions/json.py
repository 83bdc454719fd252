"""JSON column functions.

All of them are built-in Catalyst expressions (``from_json``, ``explode``,
``to_json``, variant functions) so they stay inside whole-stage codegen and
never leave the JVM.  Unreadable documents follow Spark's PERMISSIVE
``from_json``: a malformed document parses to null and explodes to zero
rows; a field that cannot be read as its declared type is null in that field
only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schemas import struct_ddl

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_json_struct(json_col: ColumnLike, columns_ddl: str) -> Column:
    """JSON text -> struct by a declared DDL (any nesting depth).

    ``columns_ddl`` is a column list such as ``"count int, data array<...>"``.
    Catalyst prunes unused top-level fields of the parsed struct, so pass a
    DDL that names only what is needed to keep the parse narrow.
    """
    return F.from_json(_col(json_col), columns_ddl)


def explode_array(df: DataFrame, array_col: ColumnLike, alias: str,
                  keep: Sequence[str] = ()) -> DataFrame:
    """One row per array element; null or empty arrays give zero rows."""
    return df.select(*keep, F.explode(_col(array_col)).alias(alias))


def explode_nested(df: DataFrame, outer_col: ColumnLike, inner_field: str,
                   outer_alias: str, inner_alias: str,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Explode ``outer`` then its ``inner_field`` array.

    A parent survives only if its inner array is non-empty (inner join
    semantics of two generators).
    """
    first = df.select(*keep, F.explode(_col(outer_col)).alias(outer_alias))
    return first.select(*keep, outer_alias,
                        F.explode(F.col(f"{outer_alias}.{inner_field}")).alias(inner_alias))


def unnest_extract_json_text(df: DataFrame, json_col: ColumnLike, fields: Sequence[str],
                             keep: Sequence[str] = ()) -> DataFrame:
    """JSON array text -> one row per element, each field as JSON text.

    Output is JSON text per field: strings keep their quotes, a JSON null is
    the text ``null`` and a missing member is SQL NULL.  Unreadable documents
    and non-arrays yield zero rows.  A fractional number prints as a double
    (``23.0`` stays ``23.0``, ``1.50`` is ``1.5``); inside nested members
    ``23.0`` prints ``23``.  A document is read once as a whole, so the time is
    linear in the length of its array.
    """
    arr = F.try_variant_get(F.try_parse_json(_col(json_col)), "$", "array<variant>")
    # a string field of a parsed struct holds a number's own text
    texts = F.from_json(_col(json_col), T.ArrayType(T.StructType(
        [T.StructField(name, T.StringType()) for name in fields])))
    # both forms of an element leave the generator together: an expression above
    # it would read the whole document again for every element
    parsed = df.select(*keep, arr.alias("_elems"), F.coalesce(texts, F.array()).alias("_texts"))
    exploded = parsed.select(*keep, F.explode(F.arrays_zip("_elems", "_texts")).alias("_row"))
    # the longer list sets the zip's length, and only elements count
    elements = exploded.filter(F.col("_row._elems").isNotNull())

    def member(name: str) -> Column:
        value = F.variant_get(F.col("_row._elems"), f"$.{_quote_path(name)}", "variant")
        number = F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        own = F.col("_row._texts")[name]
        return F.coalesce(F.when(number, own), F.to_json(value)).alias(name)

    return elements.select(*keep, *[member(f) for f in fields])


def _quote_path(field: str) -> str:
    if field.isidentifier():
        return field
    return "['" + field.replace("'", "\\'") + "']"


def ddl_of_variant_schema(schema: str) -> str:
    """``struct<...>`` of the members that ``schema_of_variant`` names for an object.

    Whole numbers are ``bigint``, others ``double`` and members that were only
    null ``string``, as in Spark's own JSON inference; members of several types
    are kept as their text.  A schema that is no object gives ``""``.
    """
    if not schema.startswith("OBJECT<"):
        return ""
    types = {"OBJECT": "struct", "VOID": "string", "VARIANT": "string", "FLOAT": "double"}
    # quoted names stay as they are
    parts = re.split(r"(`(?:[^`]|``)*`)", schema)
    for i in range(0, len(parts), 2):
        part = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "double", parts[i])
        parts[i] = re.sub(r"(?:(?<=: )|(?<=<)|^)(OBJECT|VOID|VARIANT|FLOAT)\b(?!:)",
                          lambda m: types[m[1]], part)
    ddl = "".join(parts).replace("struct<>", "string")
    return ddl if ddl.startswith("struct<") else ""


def schemas_of(df: DataFrame, json_col: ColumnLike, group_col: ColumnLike) -> DataFrame:
    """(group, schema): the DDL that all JSON objects of a group agree with,
    aggregated where the rows are (partial schemas are merged, no row moves).
    Rows that are no readable objects don't count; a group without any has null."""
    merged = F.schema_of_variant_agg(F.try_parse_json(_col(json_col)))
    grouped = df.groupBy(group_col).agg(merged.alias("_merged"))
    return grouped.withColumn("schema", F.nullif(_ddl_udf()("_merged"), F.lit(""))).drop("_merged")


def _ddl_udf():
    """``ddl_of_variant_schema`` for one text per group."""
    return F.udf(ddl_of_variant_schema, T.StringType(), useArrow=False)


def to_json_text(*cols: ColumnLike, pretty: bool = False) -> Column:
    """record(s) -> JSON text. One column that is a struct/array/map is
    serialised as is; several columns are wrapped into a struct."""
    cs = [_col(c) for c in cols]
    target = cs[0] if len(cs) == 1 else F.struct(*cs)
    return F.to_json(target, {"pretty": "true"}) if pretty else F.to_json(target)


def first_nonempty_list(json_col: ColumnLike) -> Column:
    """Envelope unwrap -> array of element JSON texts.

    A top-level list is itself; an object yields its first member, in
    document order, whose value is a non-empty list (``[null]`` counts as
    non-empty; a string that merely looks like a list does not); anything
    else yields null, which callers route to a reject output.
    """
    c = _col(json_col)
    # objects (the usual envelope) are parsed once, in member order; only
    # documents that are not objects fall through to the list parse
    members = F.map_values(F.from_json(c, "map<string,variant>"))
    lists = F.transform(members, lambda v: F.try_variant_get(v, "$", "array<variant>"))
    nonempty = F.filter(lists, lambda a: F.size(a) > 0)
    top = F.try_variant_get(F.try_parse_json(c), "$", "array<variant>")
    chosen = F.when(members.isNotNull(), F.get(nonempty, 0)).otherwise(top)
    return F.transform(chosen, lambda v: F.to_json(v))


def member_or_empty(df: DataFrame, json_col: ColumnLike, member: str, element_ddl: str,
                    alias: str = "elem", keep: Sequence[str] = ()) -> DataFrame:
    """Elements of ``member`` if present, else zero rows."""
    parsed = F.from_json(_col(json_col), f"{member} array<{struct_ddl(element_ddl)}>")
    return df.select(*keep, F.explode(parsed[member]).alias(alias))


def flatten_struct(df: DataFrame, struct_col: str, fields: Iterable[str] | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """P2 helper: ``struct.x`` -> top-level ``x`` (all fields when None)."""
    if fields is None:
        return df.select(*keep, f"{struct_col}.*")
    return df.select(*keep, *[F.col(f"{struct_col}.{f}").alias(f) for f in fields])
