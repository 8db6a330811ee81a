"""Semi-structured (VARIANT) column helpers — native expressions only.

Paths are written ``a.b[0].c`` (or with a leading ``$.``); keys are
case-sensitive and a missing path yields NULL, never an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jpath(path: str) -> str:
    """Normalise ``a:b.c`` / ``a.b`` / ``$.a.b`` to a JSONPath ``$.a.b``."""
    p = path.strip().replace(":", ".")
    if p.startswith("$"):
        return p
    return "$." + p if not p.startswith("[") else "$" + p


def vget(col: ColumnOrName, path: str, type_: str = "string") -> Column:
    """Path extraction + cast (P1/F1/F2): NULL when missing or not castable."""
    return F.try_variant_get(_c(col), jpath(path), type_)


def vget_first(col: ColumnOrName, paths: Sequence[str], type_: str = "string") -> Column:
    """Schema-drift coalesce (P2): first non-NULL of alternative paths."""
    return F.coalesce(*[vget(col, p, type_) for p in paths])


def vpresent(col: ColumnOrName, path: str) -> Column:
    """True when the key exists — an explicit JSON ``null`` counts as present."""
    return vget(col, path, "variant").isNotNull()


def no_error(data: ColumnOrName = "data", value: ColumnOrName = "value") -> Column:
    """Error-record filter (P7): neither ``value.data.error`` nor ``data.error`` present."""
    return ~vpresent(value, "data.error") & ~vpresent(data, "error")


def not_empty_array(col: ColumnOrName) -> Column:
    """Empty-payload filter (P8): ``DATA <> '[]'``; NULL payloads drop too.
    Probes the value's type instead of serialising the payload to text."""
    c = _c(col)
    n = F.size(F.try_variant_get(c, "$", "array<variant>"))
    return c.isNotNull() & F.coalesce(n != 0, F.lit(True))


def vsize(col: ColumnOrName, path: str | None = None) -> Column:
    """ARRAY_SIZE (F5): element count; NULL for missing or non-array."""
    base = _c(col) if path is None else vget(col, path, "variant")
    arr = F.try_variant_get(base, "$", "array<variant>")
    return F.when(arr.isNotNull(), F.size(arr))


def is_object(col: ColumnOrName) -> Column:
    """IS_OBJECT (P13/F9): a type probe (an object converts to a map)."""
    return F.try_variant_get(_c(col), "$", "map<string,variant>").isNotNull()


def is_array(col: ColumnOrName) -> Column:
    return F.try_variant_get(_c(col), "$", "array<variant>").isNotNull()


def parse_or_text(col: ColumnOrName) -> Column:
    """TRY_PARSE_JSON(x) falling back to the raw string as a VARIANT."""
    s = _c(col)
    return F.coalesce(F.try_parse_json(s), s.cast("variant"))


def vstring(col: ColumnOrName) -> Column:
    """VARIANT → STRING: strings unquoted, objects/arrays as JSON text."""
    return _c(col).cast("string")
