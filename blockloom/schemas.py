"""Schemas of the input records and of the stored tables."""

from __future__ import annotations

# --- input: one nested record per block ------------------------------------------
# Sub-documents that may be malformed or arbitrarily deep (access list, call trace) are
# read as JSON text, so that one bad field cannot void the record.

TX = """struct<hash:string, nonce:string, blockHash:string, blockNumber:string, transactionIndex:string,
 `from`:string, `to`:string, value:string, gas:string, gasPrice:string, input:string, type:string,
 maxFeePerGas:string, maxPriorityFeePerGas:string, accessList:string>"""

LOG = """struct<address:string, topics:array<string>, data:string, blockNumber:string, transactionHash:string,
 transactionIndex:string, blockHash:string, logIndex:string, removed:boolean>"""

RECEIPT = f"""struct<blockHash:string, blockNumber:string, contractAddress:string, cumulativeGasUsed:string,
 effectiveGasPrice:string, `from`:string, gasUsed:string, logs:array<{LOG}>, status:string, `to`:string,
 transactionHash:string, transactionIndex:string, type:string>"""

TRACE = "struct<txHash:string, result:string>"

BLOCK_FIELDS = """number:string, hash:string, parentHash:string, timestamp:string, miner:string, difficulty:string,
 totalDifficulty:string, size:string, gasLimit:string, gasUsed:string, baseFeePerGas:string, blockGasCost:string,
 stateRoot:string, transactionsRoot:string, receiptsRoot:string, extraData:string, blockExtraData:string,
 extDataHash:string, extDataGasUsed:string, mixHash:string, nonce:string, sha3Uncles:string, uncles:array<string>,
 blobGasUsed:string, excessBlobGas:string, parentBeaconBlockRoot:string, minDelayExcess:string,
 timestampMilliseconds:string"""

BLOCK = f"struct<{BLOCK_FIELDS}, transactions:array<{TX}>>"

NESTED_BLOCK = f"block {BLOCK}, traces array<{TRACE}>, receipts array<{RECEIPT}>"

PLATFORM_BLOCK = """blockID string, height bigint, parentID string, timestamp bigint,
 transactions array<struct<txID:string, txType:string, txData:string>>"""

REGISTRY_ENTRY = """subnetId string, network string, categories array<string>, name string, description string,
 logo string, website string"""

VALIDATOR_INFO = """subnetID string, txID string, startTime string, endTime string, weight string, nodeID string,
 validationID string, balance string, uptime string, connected boolean"""

# --- stored tables ---------------------------------------------------------------

RAW_BLOCKS = """chain_id bigint, block_number bigint, hash binary, parent_hash binary, block_time timestamp, miner binary,
 difficulty int, total_difficulty decimal(20,0), size bigint, gas_limit bigint, gas_used bigint,
 base_fee_per_gas decimal(20,0), block_gas_cost decimal(20,0), state_root binary, transactions_root binary,
 receipts_root binary, extra_data binary, block_extra_data binary, ext_data_hash binary, ext_data_gas_used bigint,
 mix_hash binary, nonce binary, sha3_uncles binary, uncles array<binary>, blob_gas_used bigint,
 excess_blob_gas decimal(20,0), parent_beacon_block_root binary, min_delay_excess decimal(20,0)"""

RAW_TXS = """chain_id bigint, hash binary, block_number bigint, block_hash binary, block_time timestamp,
 transaction_index int, nonce decimal(20,0), `from` binary, `to` binary, value binary, gas_limit bigint,
 gas_price decimal(20,0), gas_used bigint, success boolean, input binary, type int, max_fee_per_gas decimal(20,0),
 max_priority_fee_per_gas decimal(20,0), priority_fee_per_gas decimal(20,0), base_fee_per_gas decimal(20,0),
 contract_address binary, access_list array<struct<address:binary, storage_keys:array<binary>>>"""

RAW_TRACES = """chain_id bigint, tx_hash binary, block_number bigint, block_time timestamp, transaction_index int,
 trace_address array<int>, `from` binary, `to` binary, gas bigint, gas_used bigint, value binary, input binary,
 output binary, call_type string, tx_success boolean, tx_from binary, tx_to binary"""

RAW_LOGS = """chain_id bigint, address binary, block_number bigint, block_hash binary, block_time timestamp,
 transaction_hash binary, transaction_index int, log_index bigint, tx_from binary, tx_to binary, topic0 binary,
 topic1 binary, topic2 binary, topic3 binary, data binary, removed boolean"""

P_CHAIN_TXS = "tx_id string, tx_type string, block_number bigint, block_time timestamp, p_chain_id bigint, tx_data variant"

METRICS = """chain_id bigint, metric_name string, granularity string, period timestamp, value decimal(38,0),
 computed_at timestamp"""

WATERMARKS = """chain_id bigint, indexer_name string, granularity string, last_period timestamp, last_block_num bigint,
 updated_at timestamp, epoch bigint"""

VALIDATOR_STATE = """subnet_id string, validation_id string, node_id string, balance decimal(20,0), weight decimal(20,0),
 start_time timestamp, end_time timestamp, uptime_percentage double, active boolean, initial_deposit decimal(20,0),
 total_topups decimal(20,0), refund_amount decimal(20,0), fees_paid decimal(20,0), last_updated timestamp,
 p_chain_id bigint"""

SUBNETS = """subnet_id string, created_block bigint, created_time timestamp, subnet_type string, chain_id string,
 converted_block bigint, converted_time timestamp, p_chain_id bigint, last_updated timestamp"""

SUBNET_CHAINS = """chain_id string, subnet_id string, chain_name string, vm_id string, created_block bigint,
 created_time timestamp, p_chain_id bigint, last_updated timestamp"""

RAW_TABLES = {"raw_blocks": RAW_BLOCKS, "raw_txs": RAW_TXS, "raw_traces": RAW_TRACES, "raw_logs": RAW_LOGS}
