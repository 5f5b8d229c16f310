"""Row validation: every rule a row breaks, by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import text as X


# Types whose every non-NULL value is a valid integer, or a valid time.
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


class _Rules:
    """Rules on the columns of one schema. A column that is typed already only needs
    a value; text has to have the right form."""

    def __init__(self, schema: T.StructType):
        self.types = {field.name: field.dataType for field in schema}

    def _right(self, name: str, check) -> Column:
        kind = self.types[name]
        whole = isinstance(kind, INTEGERS) or (isinstance(kind, T.DecimalType) and kind.scale == 0)
        if (check is X.is_integer and whole) or (check is X.is_timestamp and isinstance(kind, TIMES)):
            return F.col(name).isNotNull()
        return F.coalesce(check(F.col(name).cast("string")), F.lit(False))

    def require(self, name: str, check) -> Column:
        """Name of the rule if the value is absent or wrong."""
        return F.when(~self._right(name, check), F.lit(name))

    def items(self, name: str, needed: bool = False, free: tuple[str, ...] = ()) -> Column:
        """Name of the rule if an item of a list, or one of its fields but the ``free`` ones, is NULL."""
        kind = self.types.get(name)
        if not isinstance(kind, T.ArrayType):
            return _present(name) if needed and kind is not None else F.lit(None).cast("string")
        bad = F.coalesce(F.exists(name, lambda x: _lacks(x, kind.elementType, free)), F.lit(False))
        return F.when((F.col(name).isNull() | bad) if needed else bad, F.lit(name))

    def optional(self, name: str, check) -> Column:
        return F.when(F.col(name).isNotNull() & ~self._right(name, check), F.lit(name))


def _lacks(item: Column, kind: T.DataType, free: tuple[str, ...]) -> Column:
    out = item.isNull()
    if isinstance(kind, T.StructType):
        for field in kind:
            if field.name not in free:
                out = out | _lacks(item[field.name], field.dataType, free)
    elif isinstance(kind, T.ArrayType):
        out = out | F.exists(item, lambda x: x.isNull())
    return out


def _present(name: str) -> Column:
    return F.when(F.col(name).isNull(), F.lit(name))


def _amount(text: Column) -> Column:
    return X.is_asset(text) | X.is_integer(text)


def _violations(rules: list[Column]) -> Column:
    # Joining text skips NULLs in generated code; only bad rows are split into an array.
    broken = F.concat_ws(",", *rules)
    return F.when(broken == "", F.array().cast("array<string>")).otherwise(F.split(broken, ","))


def _valid(rules: list[Column]) -> Column:
    return F.concat_ws(",", *rules) == ""


def transaction_rules(schema: T.StructType, strict: bool = False) -> list[Column]:
    rules = _Rules(schema)
    return [
        rules.require("ts", X.is_timestamp),
        rules.require("trx_id", X.is_bare_hash),
        _present("action_ordinal"),
        rules.require("hash", lambda c: X.is_hash(c, strict)),
        rules.optional("from", X.is_address),
        rules.optional("to", X.is_address),
        _present("trx_index"),
        _present("block"),
        rules.require("block_hash", X.is_bare_hash),
        rules.require("input_data", X.is_hex),
        rules.require("input_trimmed", X.is_hex),
        rules.require("value_hex", X.is_bare_hex),
        rules.require("value_d", _amount),
        *[rules.require(name, X.is_integer) for name in INTEGER_FIELDS],
        _present("status"),
        rules.items("itxs", needed=True, free=("extra",)),
        _present("epoch"),
        rules.require("createdaddr", lambda c: (c == "") | X.is_bare_address(c)),
        _present("output"),
        rules.items("logs"),
        rules.optional("logs_bloom", X.is_bare_hex),
        rules.items("errors"),
        rules.require("v", X.is_integer),
        rules.require("r", X.is_hex),
        rules.require("s", X.is_hex),
    ]


INTEGER_FIELDS = ("nonce", "gas_price", "gas_limit", "gasused", "gasusedblock", "charged_gas_price")
IDENTITY = {
    "ts": X.is_timestamp,
    "native_hash": X.is_bare_hash,
    "evm_hash": X.is_bare_hash,
    "evm_prev_hash": X.is_bare_hash,
}
BODY = {
    "receipts_root": X.is_bare_hash,
    "transactions_root": X.is_bare_hash,
    "gas_used": X.is_integer,
    "gas_limit": X.is_integer,
    "size": X.is_integer,
}


def genesis_rules(schema: T.StructType) -> list[Column]:
    """The six identity fields, which a genesis block has too."""
    rules = _Rules(schema)
    return [_present("block_num"), _present("evm_block_num")] + [
        rules.require(name, check) for name, check in IDENTITY.items()
    ]


def block_rules(schema: T.StructType) -> list[Column]:
    rules = _Rules(schema)
    return genesis_rules(schema) + [rules.require(name, check) for name, check in BODY.items()]


def validate_tx(df: DataFrame, strict: bool = False) -> DataFrame:
    """Adds ``violations``, the broken rules; an empty array is a valid row."""
    return df.withColumn("violations", _violations(transaction_rules(df.schema, strict)))


def validate_blocks(df: DataFrame, genesis_ok: bool = True) -> DataFrame:
    """Adds ``violations`` and ``shape``: block, genesis (only with ``genesis_ok``) or invalid."""
    full = df.withColumns(
        {"violations": _violations(block_rules(df.schema)), "_genesis": _valid(genesis_rules(df.schema))}
    )
    shape = F.when(F.size("violations") == 0, "block")
    if genesis_ok:
        shape = shape.when(F.col("_genesis"), "genesis")
    return full.withColumn("shape", shape.otherwise("invalid")).drop("_genesis")


def with_storable(df: DataFrame, kind: str) -> DataFrame:
    """Adds ``storable``. Blocks only need the identity fields for it."""
    rules = transaction_rules(df.schema) if kind == "transaction" else genesis_rules(df.schema)
    return df.withColumn("storable", _valid(rules))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine with its violations)."""
    good = df.where(F.size("violations") == 0).drop("violations")
    return good, df.where(F.size("violations") > 0)
