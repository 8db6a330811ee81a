"""Column → Column helpers (native Spark expressions, no UDFs)."""

from .rpc import block_request, rpc_request, tx_count_request, tx_search_request
from .text import (contains_ci, decode_or_keep, partition_key_from_path, surrogate_key,
                   try_base64_decode)
from .time import (BLOCK_TS_FORMAT, closed_hour_cond, format_block_ts, hour_floor,
                   parse_block_ts, settled_cond, ts_lit)
from .variant import (is_array, is_object, jpath, no_error, not_empty_array, parse_or_text, vget,
                      vget_first, vpresent, vsize, vstring)

__all__ = [n for n in dir() if not n.startswith("_")]
