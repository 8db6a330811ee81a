"""JSON-RPC request bodies as JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .variant import ColumnOrName, _c


def rpc_request(method: str, params: list[Column], id_: ColumnOrName | None = None) -> Column:
    """``{"id":…,"jsonrpc":"2.0","method":…,"params":[…]}``. Keys are emitted
    in sorted order and NULL-valued keys are omitted, like OBJECT_CONSTRUCT.
    Params may mix types (string, boolean, number)."""
    fields = []
    if id_ is not None:
        fields.append(_c(id_).alias("id"))
    fields += [F.lit("2.0").alias("jsonrpc"), F.lit(method).alias("method"),
               F.array(*[p.cast("variant") for p in params]).alias("params")]
    return F.to_json(F.struct(*fields))


def block_request(block_id: ColumnOrName) -> Column:
    return rpc_request("block", [_c(block_id).cast("string")], block_id)


def tx_search_request(block_id: ColumnOrName, page: ColumnOrName, per_page: int = 100,
                      order: str = "asc") -> Column:
    q = F.concat(F.lit("tx.height="), _c(block_id).cast("string"))
    return rpc_request("tx_search", [q, F.lit(True), _c(page).cast("string"),
                                     F.lit(str(per_page)), F.lit(order)], block_id)


def tx_count_request(block_id: ColumnOrName) -> Column:
    """tx_search asking for page 1 of size 1 — only ``total_count`` is used."""
    return tx_search_request(block_id, F.lit(1), per_page=1)
