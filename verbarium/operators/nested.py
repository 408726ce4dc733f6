"""Deeply nested records as related flat tables, by Dewey labels.

Every scalar and every array element of a record is a node. Its label is the list of ordinals on the way to
it: the field's place in its struct, then the element's place in its array, both from 1. Cutting a label short
gives its parent's label, and the field names alone give the schema path by which nodes fall into tables. All
labels of a record are made by array expressions inside the JVM and leave it in one explode, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NODE = "array<struct<field_path:string,label:array<int>,pos:array<int>,value:string,fields:map<string,string>,up:int>>"


def _is_scalar(t: T.DataType) -> bool:
    return not isinstance(t, (T.StructType, T.ArrayType, T.MapType))


def _wanted(path: str, paths: set[str] | None) -> bool:
    """Whether the subtree at ``path`` holds any of ``paths``."""
    return paths is None or any(p == path or p.startswith(path + ".") for p in paths)


def _struct_fields(t: T.DataType) -> list[tuple[int, T.StructField]]:
    return list(enumerate(t.fields, 1)) if isinstance(t, T.StructType) else []


def _node(path: str, label: Column, pos: Column, value: Column, fields: Column, up: int) -> Column:
    return F.array(F.struct(F.lit(path).alias("field_path"), label.alias("label"), pos.alias("pos"), value.cast("string").alias("value"), fields.alias("fields"), F.lit(up).alias("up"))).cast(_NODE)


def _scalars(value: Column, t: T.DataType) -> Column:
    """The scalar fields of a struct as one map, by which a table row is made."""
    own = [(f.name, value[f.name].cast("string")) for _, f in _struct_fields(t) if _is_scalar(f.dataType)]
    return F.create_map(*[x for n, v in own for x in (F.lit(n), v)]) if own else F.lit(None).cast("map<string,string>")


def _walk(value: Column, t: T.DataType, path: str, label: Column, pos: Column, paths: set[str] | None, up: int = 0) -> Column:
    """``up``: ordinals by which the node's label is longer than its parent's."""
    none = F.array().cast(_NODE)
    if isinstance(t, T.MapType):  # a map is an array of its entries
        entries = T.ArrayType(T.StructType([T.StructField("key", t.keyType), T.StructField("value", t.valueType)]))
        return _walk(F.map_entries(value), entries, path, label, pos, paths, up)
    if isinstance(t, T.ArrayType):
        inner = t.elementType

        def element(x: Column, i: Column) -> Column:
            lab, at = F.concat(label, F.array(i + 1)), F.concat(pos, F.array(i + 1))
            below = _walk(x, inner, path, lab, at, paths, up + 1)
            return below if _is_scalar(inner) or isinstance(inner, T.ArrayType) else F.concat(_node(path, lab, at, F.lit(None), _scalars(x, inner), up + 1), below) if paths is None or path in paths else below

        return F.coalesce(F.flatten(F.transform(value, element)), none)
    if isinstance(t, T.StructType):
        parts = [_walk(value[f.name], f.dataType, f"{path}.{f.name}" if path else f.name, F.concat(label, F.array(F.lit(k))), pos, paths, 1) for k, f in _struct_fields(t) if _wanted(f"{path}.{f.name}" if path else f.name, paths)]
        return F.concat(*parts) if parts else none
    return _node(path, label, pos, value, F.lit(None), up) if paths is None or path in paths else none


def dewey_nodes(records: DataFrame, root_key: Column, columns: list[str], paths: set[str] | None = None) -> DataFrame:
    """All nodes below ``columns``: ``(root_key, field_path, label, parent_label, pos, value, fields)``.

    ``label`` and ``parent_label`` are dotted Dewey labels; the parent of an array element is the node holding
    the array, so its label is two ordinals shorter (field and element). ``pos`` has the places in the arrays
    only. ``value`` is a scalar's text, ``fields`` an element's own scalars. With ``paths`` only nodes of these
    schema paths come out and other subtrees are not read. Null arrays and structs have no nodes below; null
    elements count for the places and have a node with null contents. Repeated records repeat their nodes.
    Names in ``records`` outside ``columns`` are not read and may clash freely.
    """
    schema = T.StructType([records.schema[c] for c in columns])
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    nodes = _walk(whole, schema, "", F.array().cast("array<int>"), F.array().cast("array<int>"), paths)
    # outer, as for the inner explode Catalyst would add a filter that walks the record a second time
    flat = records.select(root_key.alias("root_key"), F.explode_outer(nodes).alias("n")).filter("n is not null").select("root_key", "n.*")
    parent = F.array_join(F.slice("label", 1, F.size("label") - F.col("up")), ".")
    return flat.select("root_key", "field_path", F.array_join("label", ".").alias("label"), parent.alias("parent_label"), "pos", "value", "fields")


def dewey_table(nodes: DataFrame, path: str, fields: dict[str, str] | None = None) -> DataFrame:
    """The flat table of one schema path: ``(root_key, label, parent_label, place, ...)``, distinct.

    With ``fields`` (name to type) the scalars of array elements become columns, else ``value`` does. Records
    delivered twice give their rows once.
    """
    rows = nodes.filter(F.col("field_path") == path)
    cols = [F.try_element_at("fields", F.lit(n)).cast(t).alias(n) for n, t in fields.items()] if fields else [F.col("value")]
    return rows.select("root_key", "label", "parent_label", F.array_join("pos", ".").alias("place"), *cols).distinct()


#: A value is blank if it has no character beside white space.
NOT_BLANK = r"[^\s\p{Z}\x1c-\x1f\x85]"


def placed_values(nodes: DataFrame) -> DataFrame:
    """``(root_key, field_path, outer_pos, inner_pos)`` of non-null, non-blank values, distinct; places from 1, 0 if none."""
    place = lambda k: F.coalesce(F.get("pos", F.lit(k)), F.lit(0)).cast("int")
    return nodes.filter(F.col("value").rlike(NOT_BLANK)).select("root_key", "field_path", place(0).alias("outer_pos"), place(1).alias("inner_pos")).distinct()
