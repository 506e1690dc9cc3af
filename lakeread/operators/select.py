"""Projection of columns and of fields inside structs, arrays and maps, by dotted paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pseudo-fields: the elements of an array or the keys of a map, and the values of a map.
FIRST, SECOND = "$0", "$1"


def paths(text: str) -> dict:
    """The tree of comma-separated dotted paths; a path that is asked for as a whole holds all of it."""
    tree: dict = {}
    for path in filter(None, (p.strip() for p in text.split(","))):
        at, parts = tree, path.split(".")
        for i, part in enumerate(parts):
            if at.get(part, 0) is None:
                break
            if i == len(parts) - 1:
                at[part] = None
            else:
                at = at.setdefault(part, {})
    return tree


def _pruned(column: Column, kind: T.DataType, tree: dict | None, path: str) -> Column:
    if not tree:
        return column
    if isinstance(kind, T.StructType):
        names = kind.fieldNames()
        if unknown := set(tree) - set(names):
            raise ValueError(f"no field {sorted(unknown)} in {path}")
        fields = [_pruned(column[n], kind[n].dataType, tree[n], f"{path}.{n}").alias(n) for n in names if n in tree]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        if set(tree) != {FIRST}:
            raise ValueError(f"an array has {FIRST} only: {path}")
        return F.transform(column, lambda x: _pruned(x, kind.elementType, tree[FIRST], f"{path}.{FIRST}"))
    if isinstance(kind, T.MapType):
        if set(tree) == {FIRST}:
            return F.map_keys(column)
        if set(tree) == {SECOND}:
            return F.transform(F.map_values(column), lambda x: _pruned(x, kind.valueType, tree[SECOND], f"{path}.{SECOND}"))
        if set(tree) == {FIRST, SECOND}:
            return F.transform_values(column, lambda _, x: _pruned(x, kind.valueType, tree[SECOND], f"{path}.{SECOND}"))
        raise ValueError(f"a map has {FIRST} and {SECOND} only: {path}")
    raise ValueError(f"nothing to select in {path}")


def select(df: DataFrame, columns: list[str], nested: str = "") -> DataFrame:
    """The columns in the order asked for, those with nested paths rebuilt from the fields that the paths name.

    Fields keep the table's order and their names; null structs stay null. A map with $0 alone becomes the array of its
    keys, with $1 alone that of its values. Unknown columns and fields raise ValueError. Catalyst prunes the scan of
    struct fields to those that are left.
    """
    if unknown := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no column {unknown}")
    tree = paths(nested)
    return df.select(*(_pruned(df[c], df.schema[c].dataType, tree.get(c), c).alias(c) for c in columns))
