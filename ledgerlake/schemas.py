"""Contract schemas: raw (as published) and decoded, per kind."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DecimalType, LongType, MapType, StringType, StructField, StructType,
)

# Fixed values of the archive contract.
KINDS = ("blocks", "txs", "events")
DEFAULT_CHAIN_ID = 43114
WEI_TYPE = DecimalType(38, 0)

# Columns decoded from hex on load, per kind.
WEI_COLUMNS = {
    "blocks": ("base_fee_per_gas",),
    "txs": ("value", "effective_gas_price", "gas_price", "max_priority_fee_per_gas"),
    "events": (),
}
INT_COLUMNS = {
    "blocks": (),
    "txs": (),
    "events": ("log_index",),
}

# Natural row order per kind (Spark has none; used wherever order is observable).
ORDER_KEYS = {
    "blocks": ("number",),
    "txs": ("block_number", "tx_hash"),
    "events": ("block_number", "log_index", "tx_hash"),
}

# Which column holds the block number per kind.
BLOCK_COLUMN = {"blocks": "number", "txs": "block_number", "events": "block_number"}


def _s(name: str, nullable: bool = True) -> StructField:
    return StructField(name, StringType(), nullable)


def _l(name: str, nullable: bool = True) -> StructField:
    return StructField(name, LongType(), nullable)


RAW = {
    "blocks": StructType([
        _l("number"), _l("timestamp"), _l("gas_used"), _l("gas_limit"),
        _s("base_fee_per_gas"),
    ]),
    "txs": StructType([
        _l("block_number"), _s("tx_hash"), _s("from_address"), _s("to_address"),
        _s("value"), _l("gas_used"), _s("effective_gas_price"), _s("gas_price"),
        _s("max_priority_fee_per_gas"), _l("type"), _l("status"), _s("input_prefix"),
    ]),
    "events": StructType([
        _l("block_number"), _s("tx_hash"), _s("log_index"), _s("address"),
        _s("topic0"), _s("topic1"), _s("topic2"), _s("topic3"), _s("data"),
    ]),
}


def decoded_schema(kind: str) -> StructType:
    fields = []
    for f in RAW[kind].fields:
        if f.name in WEI_COLUMNS[kind]:
            fields.append(StructField(f.name, WEI_TYPE, True))
        elif f.name in INT_COLUMNS[kind]:
            fields.append(StructField(f.name, LongType(), True))
        else:
            fields.append(f)
    return StructType(fields)


FILE_ENTRY = StructType([
    _s("date"), _s("kind"), _s("key"), _l("size"), _s("md5"), _s("schema_version"),
])
LOOKUP_ENTRY = StructType([_s("key"), _l("size"), _s("md5")])

MANIFEST = StructType([
    _l("chain_id"),
    _s("generated_at"),
    _s("schema_version"),
    _s("latest_complete_date"),
    StructField("columns", MapType(StringType(), ArrayType(StringType())), True),
    StructField("lookups", MapType(StringType(), LOOKUP_ENTRY), True),
    StructField("files", ArrayType(FILE_ENTRY), True),
])

CANDIDATE = StructType([
    _s("signature"), _l("count"), _s("abi"),
])


def check_kind(kind: str) -> str:
    """Raise early on an unknown kind, before any file is touched."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}; expected one of {', '.join(KINDS)}")
    return kind
