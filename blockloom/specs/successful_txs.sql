-- A user-defined metric: successful transactions per period.
SELECT chain_id, 'successful_txs' AS metric_name, '{granularity}' AS granularity,
       date_trunc('{granularity}', block_time) AS period, count(*) AS value
FROM raw_txs
WHERE chain_id = :chain_id AND block_time >= :first_period AND block_time < :last_period AND success
GROUP BY 1, 4
