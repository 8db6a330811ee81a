"""String helpers: base64 detection/decoding, surrogate keys, path parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .variant import ColumnOrName, _c

# The NULL placeholder and separator of the public
# dbt_utils generate_surrogate_key macro (v1.x); keys must equal it.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def try_base64_decode(col: ColumnOrName) -> Column:
    """TRY_BASE64_DECODE_STRING (F12): NULL unless ``col`` is padded base64
    that decodes to valid UTF-8."""
    c = _c(col)
    decoded = F.try_validate_utf8(F.try_to_binary(c, F.lit("base64")).cast("string"))
    return F.when(F.length(c) % 4 == 0, decoded)


def decode_or_keep(key: ColumnOrName, value: ColumnOrName) -> tuple[Column, Column]:
    """Decode-or-keep (F13): the key is decoded when it is base64, else kept;
    the value is decoded iff the key decoded (so an undecodable value under an
    encoded key becomes NULL), else kept raw."""
    dk = try_base64_decode(key)
    k = F.coalesce(dk, _c(key))
    v = F.when(dk.isNull(), _c(value)).otherwise(try_base64_decode(value))
    return k, v


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 over ``-``-joined string casts, NULL → placeholder."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def partition_key_from_path(col: ColumnOrName, segment: int = 4) -> Column:
    """Partition key of a landed file (S3): the ``segment``-th ``/`` part of
    the path (1-based; negative counts from the end), text before the first
    ``_``, as INT. NULL if it is not a number."""
    parts = F.split(_c(col), "/")
    part = F.element_at(parts, segment)
    return F.split_part(part, F.lit("_"), F.lit(1)).try_cast("int")


def contains_ci(col: ColumnOrName, needle: str) -> Column:
    """``LOWER(x) LIKE '%needle%'``."""
    return F.lower(_c(col)).contains(needle.lower())
