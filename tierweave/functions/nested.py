"""Reading values by dotted paths; a missing step gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierweave.functions.base import col


def get_nested(df_schema: T.StructType, path: str) -> Column:
    """The value under ``path`` of a frame with this schema.

    Steps go through structs and maps with text keys. A step that the schema does not know, or
    that lies below a value of another kind, gives NULL.
    """
    head, *rest = path.split(".")
    if head not in df_schema.names:
        return F.lit(None)
    node, dtype = F.col(f"`{head}`"), df_schema[head].dataType
    for step in rest:
        if isinstance(dtype, T.StructType) and step in dtype.names:
            node, dtype = node.getField(step), dtype[step].dataType
        elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
            node, dtype = F.try_element_at(node, F.lit(step)), dtype.valueType
        else:
            return F.lit(None)
    return node


def get_json_nested(body: Column | str, path: str) -> Column:
    """The value under ``path`` of a JSON object as text; NULL where a step is no object or not there."""
    steps = "".join(f"['{step}']" for step in path.split("."))
    return F.get_json_object(col(body), f"${steps}")
