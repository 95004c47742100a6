"""The four fixed tables. Columns, order and nullability are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_HASHES = T.ArrayType(T.BinaryType())
_WITHDRAWALS = T.ArrayType(
    T.StructType(
        [
            T.StructField("index", T.BinaryType()),
            T.StructField("validator_index", T.BinaryType()),
            T.StructField("address", T.BinaryType()),
            T.StructField("amount", T.BinaryType()),
        ]
    )
)
_ACCESS = T.ArrayType(T.StructType([T.StructField("address", T.BinaryType()), T.StructField("storage_keys", _HASHES)]))
_AUTHORIZATIONS = T.ArrayType(
    T.StructType([T.StructField(n, T.BinaryType()) for n in ("chain_id", "address", "nonce", "y_parity", "r", "s")])
)

#: Types other than binary.
_TYPES = {
    "number": T.LongType(), "block_number": T.LongType(), "transaction_index": T.LongType(), "log_index": T.LongType(), "subtraces": T.LongType(), "transaction_position": T.LongType(),
    "type": T.ShortType(), "status": T.ShortType(), "removed": T.BooleanType(), "uncles": _HASHES, "withdrawals": _WITHDRAWALS, "access_list": _ACCESS,
    "authorization_list": _AUTHORIZATIONS, "blob_versioned_hashes": _HASHES, "trace_address": T.ArrayType(T.LongType()), "call_type": T.StringType(), "reward_type": T.StringType(), "error": T.StringType(),
}


def _table(columns: str, **types: T.DataType) -> T.StructType:
    """A `?` marks a nullable column."""
    return T.StructType(
        [
            T.StructField(
                c.rstrip("?"), types.get(c.rstrip("?"), _TYPES.get(c.rstrip("?"), T.BinaryType())), c.endswith("?")
            )
            for c in columns.split()
        ]
    )


BLOCKS = _table(
    "number hash parent_hash nonce? sha3_uncles logs_bloom transactions_root state_root receipts_root miner difficulty? total_difficulty? extra_data size gas_limit gas_used timestamp uncles? base_fee_per_gas? blob_gas_used? " "excess_blob_gas? parent_beacon_block_root? withdrawals_root? withdrawals? l1_block_number? send_count? send_root? mix_hash?",
    l1_block_number=T.LongType(),
)
TRANSACTIONS = _table(
    "block_hash block_number from? gas gas_price? hash input nonce to? transaction_index value v? r? s? max_priority_fee_per_gas? max_fee_per_gas? chain_id? cumulative_gas_used effective_gas_price gas_used contract_address? " "logs_bloom type? root? status? sighash? y_parity? access_list? authorization_list? l1_fee? l1_gas_price? l1_gas_used? l1_fee_scalar? gas_used_for_l1? max_fee_per_blob_gas? blob_versioned_hashes? deposit_nonce? blob_gas_price? " "deposit_receipt_version? blob_gas_used? l1_base_fee_scalar? l1_blob_base_fee? l1_blob_base_fee_scalar? l1_block_number? mint? source_hash?"
)
LOGS = _table(
    "removed? log_index transaction_index transaction_hash block_hash block_number address data topic0? topic1? "
    "topic2? topic3?"
)
TRACES = _table(
    "from? to? call_type? gas? input? init? value? author? reward_type? block_hash block_number address? code? gas_used? output? subtraces? trace_address? transaction_hash? transaction_position? type? error? sighash? action_address? " "balance? refund_address?",
    type=T.StringType(),
)
SCHEMAS = {"blocks": BLOCKS, "transactions": TRANSACTIONS, "logs": LOGS, "traces": TRACES}
#: The column that holds the block number in each table, and the total order of its rows.
BLOCK_COLUMN = {"blocks": "number", "transactions": "block_number", "logs": "block_number", "traces": "block_number"}
ORDER = {
    "blocks": ["number"],
    "transactions": ["block_number", "transaction_index"],
    "logs": ["block_number", "log_index"],
    "traces": ["block_number", "transaction_position", "trace_address"],
}
#: Blocks of one partition folder of a stored table.
RANGE = 10_000
