"""Fixed values that results depend on."""

# Event signatures (topic0), hex without 0x.
TRANSFER = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
DEPOSIT = "e1fffcc4923d04b559f4d29a8bfc6cda04eb5b0d3c460751c2402c5c5cc9109c"
WITHDRAWAL = "7fcf532c15f0a6db0bd6d0e038bea71d30d808c7d98cb3bf7268a95bf5081b65"
MESSAGE_SENT = "2a211ad4a59ab9d003852404f9c57c690704ee755f3c79d2c2812ad32da99df8"
MESSAGE_RECEIVED = "292ee90bbaf70b5d4936025e09d56ba08f3e421156b6a568cf3c2840d9343e34"

# The stable coin whose volume is a stock metric.
USDC_ADDRESS = "b97ef9ef8734c71904d8002f8b6bc66dd9c48a6e"
USDC_DECIMALS = 6

# Call types that create a contract.
CREATE_CALLS = ("CREATE", "CREATE2", "CREATE3")

ZERO_ADDRESS = "00" * 20
ZERO_HASH = "00" * 32

# Primary network rows of the platform chain.
PRIMARY_SUBNET = "11111111111111111111111111111111LpoYY"
GENESIS_SECONDS = 1600714800
PRIMARY_CHAINS = (
    ("2q9e4r6Mu3U68nU1fYjgbR6JvwrRx36CohpAX5UQxse55x1Q5", "C-Chain", "mgj786NP7uDwBCcq6YwThhaN8FLyybkCa4zBWTQbNgmK6k9A6"),
    ("2oYMBNV4eNHyqk2fjjV5nVQLDbtmNJzq5s3qs3Lo6ftnC6FByM", "X-Chain", "avm"),
    ("11111111111111111111111111111111LpoYY", "P-Chain", "platform"),
)

# Estimate for platform blocks without a time (2020-09-21 00:00 UTC, 2 s per block).
LAUNCH_SECONDS = 1600646400
SECONDS_PER_BLOCK = 2
TIME_LOOKBACK_BLOCKS = 100

# Fixed value: validation fee in nano-units per second.
FEE_PER_SECOND = 512

# Batch sizes of the incremental indexer, the writer and the result pager.
BLOCKS_PER_BATCH = 2000
TXS_PER_WRITE = 5000
ROWS_PER_PAGE = 200

GRANULARITIES = ("hour", "day", "week", "month")
