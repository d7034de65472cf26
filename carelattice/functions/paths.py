"""Column paths of view specifications as Spark columns.

Supported forms: ``a``, ``a.b``, ``a[i]``, ``a.where(k='v').f``, ``….first()``. A path that ends
in a list yields its first value.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = re.compile(r"where\((?P<key>\w+)='(?P<val>[^']*)'\)|(?P<first>first\(\))|(?P<name>\w+)(?:\[(?P<pos>\d+)\])?")


def first_field(path: str) -> str:
    """Top-level field a path starts from."""
    return re.match(r"\w*", path)[0]


def path_column(path: str, schema: T.StructType, root: Column) -> Column:
    col, dtype, is_list = root, schema, False
    position = 0
    while position < len(path):
        m = STEP.match(path, position)
        if not m or (m.end() < len(path) and path[m.end()] != "."):
            raise ValueError(f"unsupported path: {path}")
        position = m.end() + 1
        if m["first"]:
            col, is_list = (F.get(col, F.lit(0)) if is_list else col), False
        elif m["key"]:
            if not is_list:
                raise ValueError(f"where() needs a list: {path}")
            col = _matching(col, m["key"], m["val"])
        else:
            field = dtype[m["name"]].dataType
            if is_list:
                col = _members(col, m["name"], isinstance(field, T.ArrayType))
            else:
                col = col[m["name"]]
            if isinstance(field, T.ArrayType):
                is_list, field = True, field.elementType
            dtype = field
            if m["pos"] is not None:
                if not is_list:
                    raise ValueError(f"index needs a list: {path}")
                col, is_list = F.get(col, F.lit(int(m["pos"]))), False
    return F.get(col, F.lit(0)) if is_list else col


def _matching(col: Column, key: str, val: str) -> Column:
    return F.filter(col, lambda x: x[key] == val)


def _members(col: Column, name: str, nested: bool) -> Column:
    values = F.filter(F.transform(col, lambda x: x[name]), lambda x: x.isNotNull())
    return F.flatten(values) if nested else values
