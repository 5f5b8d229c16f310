"""Fixed values of the ledger format.

They have to be equal in every program that reads or writes these tables, so
they are written out plainly and are used from here only.
"""

# Native contract and action names.
EVM_CONTRACT = "eosio.evm"
TOKEN_CONTRACT = "eosio.token"
MULTISIG_CONTRACT = "eosio.msig"
RAW_ACTION = "raw"
WITHDRAW_ACTION = "withdraw"
TRANSFER_ACTION = "transfer"
EXEC_ACTION = "exec"
ACTION_WHITELIST = {
    TOKEN_CONTRACT: [TRANSFER_ACTION],
    MULTISIG_CONTRACT: [EXEC_ACTION],
    EVM_CONTRACT: [RAW_ACTION, WITHDRAW_ACTION],
}

# Well known addresses, hashes and limits.
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"
ZERO_HASH = "0x0000000000000000000000000000000000000000000000000000000000000000"
EMPTY_ROOT = "56e81f171bcc55a6ff8345e692c0f86e5b48e01b996cadc001622fb5e363b421"
EMPTY_UNCLES = "0x1dcc4de8dec75d7aab85b567b6ccd41ad312451b948a7413f0a142fd40d49347"
BLOCK_GAS_LIMIT = 2147483647
BLOCK_GAS_LIMIT_HEX = "0x7fffffff"
STANDARD_GAS_PRICE = 0
STANDARD_GAS_LIMIT = 21000

# Translation of native actions.
SYNTHETIC_V = 42
ASSET_SCALE_DIGITS = 14
WHOLE_TOKEN_DIGITS = 18
INPUT_TRIM = 32000
RECEIPT_START = "RCPT{{"
RECEIPT_END = "}}RCPT"
NAME_ALPHABET = ".12345abcdefghijklmnopqrstuvwxyz"
BASE32_DIGITS = "0123456789abcdefghijklmnopqrstuv"

# Messages of error rows.
ERR_RAW = "Raw EVM deserialization error"
ERR_NO_CONSOLE = "consoleLog undefined or empty string"
ERR_UNREGISTERED = "User deposited without registering"
ERR_BAD_TARGET = "User deposited to an invalid address"
ERR_BAD_ASSET = "Asset must begin with a number"
ERR_NO_ACCOUNT = "failed to get eth addr for "
ERR_BAD_ACCOUNT = "error deserializing address '"

# Defaults of the table layout and of the checks.
BLOCKS_PER_SEGMENT = 10_000_000
FORK_CHECK_WIDTH = 100
DOUBLE_FORK_DISTANCE = 1000
HISTORY_WINDOW = "15 minutes"
HEAD_DISTANCE = 100

# Physical shape of ordered work: positions of one window group, and actions of one part
# of a block. They only move work between tasks, never results.
ORDER_BUCKET = 100_000
BLOCK_PART = 60_000
