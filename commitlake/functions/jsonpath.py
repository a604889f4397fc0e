"""JSON scalar/sub-object extraction with warehouse ``JSON_VALUE`` / ``JSON_QUERY`` semantics.

One rule for every route to a scalar (``json_value``, ``parse_payload``): the leaf is read by ``from_json`` as a
string, so a number keeps the text it is written with, the last of repeated keys counts, and malformed documents give
NULL. ``JSON_VALUE`` yields NULL when the addressed value is an object or array, while the string leaf holds its JSON
text. Only a text that starts with ``[`` or ``{`` and ends with its counterpart can be one; for these rows the value is
read again as an array or a map, which succeeds for containers only, so a string such as ``"[Fix]"`` stays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_at(payload: Column, path: str, leaf: T.DataType) -> Column:
    """The value at a dotted ``path`` (``a.b``), read as ``leaf``."""
    parts = path.split(".")
    schema: T.DataType = leaf
    for name in reversed(parts):
        schema = T.StructType([T.StructField(name, schema)])
    value = F.from_json(payload, schema)
    for name in parts:
        value = value.getField(name)
    return value


def scalar_leaf(text: Column, payload: Column, path: str) -> Column:
    """``text``, the string leaf at ``path`` of ``payload``, or NULL where the value is an object or array."""
    array = T.ArrayType(T.StringType())
    object_ = T.MapType(T.StringType(), T.StringType())
    container = F.when(text.startswith("[") & text.endswith("]"), leaf_at(payload, path, array).isNotNull()).when(
        text.startswith("{") & text.endswith("}"), leaf_at(payload, path, object_).isNotNull()).otherwise(F.lit(False))
    return F.when(~container, text)


def json_value(payload: Column | str, path: str, strict: bool = True) -> Column:
    """Scalar at ``path`` (``$.a.b``) of a JSON text column, as string.

    ``strict=False`` returns the JSON text of objects/arrays as well.
    """
    payload = F.col(payload) if isinstance(payload, str) else payload
    path = path.removeprefix("$.")
    text = leaf_at(payload, path, T.StringType())
    return scalar_leaf(text, payload, path) if strict else text


def json_query(payload: Column | str, path: str) -> Column:
    """JSON text of the value at ``path`` (objects and arrays included), NULL if absent."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.to_json(F.try_variant_get(F.try_parse_json(payload), path, "variant"))
