"""Typed access to semi-structured (VARIANT) values that never fails a query."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scalar(v: Column, path: str, kind: str) -> Column:
    """A leaf as ``kind``; NULL when absent, JSON null or not convertible."""
    return F.try_variant_get(v, path, kind)


def present(v: Column, path: str) -> Column:
    """True when the path holds a value other than JSON null."""
    node = F.try_variant_get(v, path, "variant")
    return node.isNotNull() & ~F.is_variant_null(node)


def typed_struct(v: Column, path: str, schema: T.StructType) -> Column:
    """An object as a struct in one pass over the value.

    A leaf that is absent, JSON null or not convertible is NULL, and so is an inner
    struct whose object is absent or JSON null.
    """
    return F.try_variant_get(v, path, schema.simpleString())


def typed_array(v: Column, path: str, schema: T.ArrayType) -> Column:
    """An array subtree as a typed array, each element for itself.

    Absent and JSON null give NULL; a leaf that does not convert is NULL, and so is an
    element of the wrong kind, whose neighbours stay.
    """
    kind = schema.elementType
    values = F.try_variant_get(v, path, "array<variant>")
    if isinstance(kind, T.StructType):
        # JSON does not turn 1.5 into the integer 1, as a cast would.
        return F.transform(values, lambda x: F.from_json(F.to_json(x), kind))
    return F.transform(values, lambda x: F.try_variant_get(x, "$", kind.simpleString()))


def elements(v: Column, array_field: str = "elements") -> Column:
    """The parser's ordered elements as ARRAY<VARIANT>."""
    return F.try_variant_get(v, f"$.document.{array_field}", "array<variant>")


def element_text(element: Column) -> Column:
    return F.try_variant_get(element, "$.content", "string")
