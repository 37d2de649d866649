"""For each named query the same result in plain SQL, for DuckDB over the same tables.

The statements are written for being obviously right: self-joins and window functions over whole
tables, none of the rewrites the Spark side uses.
"""

from __future__ import annotations

_PLACES = """
places AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"""

STREAM = f"""WITH {_PLACES},
facts AS (
  SELECT *, event_id % (SELECT count(*) FROM supplier) AS seller,
    CASE event_type WHEN 'error' THEN 'chargeback' WHEN 'signup' THEN 'refund'
                    WHEN 'click' THEN 'p2p' ELSE 'purchase' END AS kind
  FROM events
),
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, sha256(CAST(user_id AS VARCHAR)) AS card_hash,
    CAST(s_suppkey AS VARCHAR) AS merchant_id, CAST(5000 + event_id % 20 AS VARCHAR) AS merchant_category_code,
    CASE WHEN kind IN ('refund', 'chargeback') THEN -CAST(value AS DECIMAL(18,2))
         ELSE CAST(value AS DECIMAL(18,2)) END AS amount,
    sp.r_name AS currency, ts AS "timestamp", CAST(floor(epoch(ts)) AS BIGINT) AS sec,
    kind AS transaction_type, sp.n_name AS country_code,
    CAST(s_nationkey AS VARCHAR) AS acquirer_id, CAST(c_nationkey AS VARCHAR) AS issuer_id,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 6 THEN '51' ELSE '00' END AS response_code,
    sp.r_name <> cp.r_name AS is_cross_border
  FROM facts
  JOIN supplier ON s_suppkey = seller
  JOIN places sp ON sp.n_nationkey = s_nationkey
  JOIN customer ON c_custkey = user_id
  JOIN places cp ON cp.n_nationkey = c_nationkey
)"""

LEDGER = f"""WITH {_PLACES},
facts AS (
  SELECT *, CASE WHEN l_returnflag = 'N' THEN 'purchase' WHEN l_returnflag = 'A' THEN 'refund'
                 WHEN l_linestatus = 'O' THEN 'chargeback' ELSE 'p2p' END AS kind
  FROM lineitem
),
txn AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, CAST(o_custkey AS VARCHAR) AS card_hash,
    CAST(l_suppkey AS VARCHAR) AS merchant_id, p_brand AS merchant_category_code,
    CASE WHEN kind IN ('refund', 'chargeback') THEN -CAST(l_extendedprice AS DECIMAL(18,2))
         ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
    sp.r_name AS currency, l_shipdate AS "timestamp", kind AS transaction_type, sp.n_name AS country_code,
    CAST(s_nationkey AS VARCHAR) AS acquirer_id, CAST(c_nationkey AS VARCHAR) AS issuer_id,
    CASE WHEN o_orderstatus = 'P' THEN '51' ELSE '00' END AS response_code,
    sp.r_name <> cp.r_name AS is_cross_border, s_name AS merchant_name
  FROM facts
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN places sp ON sp.n_nationkey = s_nationkey
  JOIN customer ON c_custkey = o_custkey
  JOIN places cp ON cp.n_nationkey = c_nationkey
)"""

_MONEY = "DECIMAL(28,2)"
_SETTLED = f"""
  SELECT acquirer_id, issuer_id, currency,
    count(*) FILTER (transaction_type = 'purchase') AS purchase_count,
    CAST(coalesce(sum(abs(amount)) FILTER (transaction_type = 'purchase'), 0) AS {_MONEY}) AS purchase_volume,
    count(*) FILTER (transaction_type = 'refund') AS refund_count,
    CAST(coalesce(sum(abs(amount)) FILTER (transaction_type = 'refund'), 0) AS {_MONEY}) AS refund_volume,
    count(*) FILTER (transaction_type = 'chargeback') AS chargeback_count,
    CAST(coalesce(sum(abs(amount)) FILTER (transaction_type = 'chargeback'), 0) AS {_MONEY}) AS chargeback_volume,
    processing_date
  FROM dated WHERE transaction_type <> 'p2p'
  GROUP BY acquirer_id, issuer_id, currency, processing_date"""
_SETTLEMENT = f"""
SELECT s.*, CAST(purchase_volume - refund_volume - chargeback_volume AS {_MONEY}) AS net_settlement_amount,
  acquirer_id IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation) AS acquirer_known,
  issuer_id IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation) AS issuer_known
FROM ({_SETTLED}) s"""

# One row per transaction with the three rules evaluated on it.
_SCORED = (
    STREAM
    + """,
conflicts AS (
  SELECT DISTINCT a.card_hash FROM txn a JOIN txn b
    ON a.card_hash = b.card_hash AND a.transaction_id <> b.transaction_id
   AND a.country_code <> b.country_code AND b.sec BETWEEN a.sec - 300 AND a.sec
),
history AS (
  SELECT *,
    count(*) OVER (PARTITION BY card_hash ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)
      AS velocity_count,
    count(*) OVER prior AS prior_sample_count,
    CAST(sum(amount) OVER prior AS DOUBLE) / count(*) OVER prior AS mean
  FROM txn
  WINDOW prior AS (PARTITION BY card_hash ORDER BY "timestamp", transaction_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
flags AS (
  SELECT *, velocity_count > 5 AS fraud_velocity,
    coalesce(prior_sample_count >= 3 AND CAST(amount AS DOUBLE) > mean * 3.0, false) AS fraud_amount_anomaly,
    card_hash IN (SELECT card_hash FROM conflicts) AS fraud_geo_impossibility
  FROM history
),
scored AS (
  SELECT *, fraud_velocity OR fraud_amount_anomaly OR fraud_geo_impossibility AS is_fraud_flagged,
    concat_ws('|', CASE WHEN fraud_velocity THEN 'VELOCITY' END,
              CASE WHEN fraud_amount_anomaly THEN 'AMOUNT_ANOMALY' END,
              CASE WHEN fraud_geo_impossibility THEN 'GEO_IMPOSSIBILITY' END) AS fraud_reasons
  FROM flags
)
"""
)
_SCORED_COLUMNS = """transaction_id, card_hash, amount, country_code, transaction_type,
  fraud_reasons, is_fraud_flagged"""

_MERCHANT_VOLUME = f"""
volumes AS (
  SELECT time_bucket(INTERVAL '5 minutes', "timestamp") AS window_start,
    time_bucket(INTERVAL '5 minutes', "timestamp") + INTERVAL '5 minutes' AS window_end, merchant_id,
    count(*) AS txn_count, CAST(sum(abs(amount)) AS {_MONEY}) AS total_value,
    count(DISTINCT card_hash) AS unique_cards
  FROM txn WHERE transaction_type IN ('purchase', 'p2p')
  GROUP BY ALL
)"""
_XBORDER = """
ratios AS (
  SELECT start AS window_start, start + INTERVAL '1 hour' AS window_end, issuer_id,
    count(*) AS total_txns, CAST(sum(CAST(is_cross_border AS INTEGER)) AS BIGINT) AS cross_border_txns,
    round(sum(CAST(is_cross_border AS INTEGER)) / count(*), 4) AS cross_border_ratio
  FROM (
    SELECT *, time_bucket(INTERVAL '15 minutes', "timestamp") - k * INTERVAL '15 minutes' AS start
    FROM txn, range(4) AS steps(k)
  )
  GROUP BY start, issuer_id
)"""
_XBORDER_50_20 = """
ratios AS (
  SELECT start AS window_start, start + INTERVAL '50 minutes' AS window_end, issuer_id,
    count(*) AS total_txns, CAST(sum(CAST(is_cross_border AS INTEGER)) AS BIGINT) AS cross_border_txns,
    round(sum(CAST(is_cross_border AS INTEGER)) / count(*), 4) AS cross_border_ratio
  FROM (
    SELECT *, to_timestamp(CAST(sec // 1200 - k AS BIGINT) * 1200)::TIMESTAMP AS start FROM txn, range(3) AS steps(k)
  )
  WHERE "timestamp" < start + INTERVAL '50 minutes'
  GROUP BY start, issuer_id
)"""
_CARD_DAILY = f"""
SELECT card_hash, CAST("timestamp" AS DATE) AS date, count(*) AS daily_txn_count,
  CAST(sum(abs(amount)) AS {_MONEY}) AS daily_spend, max("timestamp") AS last_seen
FROM txn WHERE transaction_type IN ('purchase', 'p2p') GROUP BY 1, 2"""

_GAPS = """,
gappy AS (
  SELECT transaction_id, card_hash, "timestamp", transaction_type,
    CASE WHEN response_code = '00' THEN amount END AS amount,
    CASE WHEN transaction_type <> 'p2p' THEN merchant_id END AS merchant_id
  FROM txn
)"""


def _ranges(source: str) -> str:
    return f"""
SELECT count(*) FILTER (transaction_type = 'purchase' AND (amount < 0.01 OR amount > 50000)) AS purchase_violations,
  count(*) FILTER (transaction_type = 'refund' AND (amount < -50000 OR amount > -0.01)) AS refund_violations,
  count(*) FILTER (transaction_type = 'chargeback' AND (amount < -50000 OR amount > -0.01)) AS chargeback_violations,
  count(*) FILTER (transaction_type = 'p2p' AND (amount < 0.01 OR amount > 10000)) AS p2p_violations
FROM {source}"""


def _orphans(source: str) -> str:
    return f"""
SELECT count(*) AS total_count,
  count(*) FILTER (merchant_id IS NULL OR merchant_id NOT IN
    (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 0)) AS orphan_count
FROM {source}"""


_DUPLICATES = """
SELECT count(*) AS total_count, count(DISTINCT transaction_id) AS unique_count,
  count(*) - count(DISTINCT transaction_id) AS duplicate_count FROM """

_REPORT = (
    LEDGER
    + _GAPS
    + f""",
r AS ({_ranges("gappy")}), o AS ({_orphans("gappy")}), d AS ({_DUPLICATES} gappy),
n AS (SELECT count(*) - count(amount) AS amounts, count(*) - count(merchant_id) AS merchants FROM gappy),
f AS (SELECT epoch(TIMESTAMP '2024-02-01' - max("timestamp")) / 3600 AS age FROM gappy),
checks AS (
  SELECT 'schema_validation' AS check_name, false AS failed, 'Every column is there' AS message,
    CAST(NULL AS DOUBLE) AS metric_value, CAST(NULL AS DOUBLE) AS threshold
  UNION ALL SELECT 'null_check', amounts + merchants > 0,
    'Required values absent, ' || concat_ws(', ',
      CASE WHEN amounts > 0 THEN 'amount: ' || amounts END,
      CASE WHEN merchants > 0 THEN 'merchant_id: ' || merchants END), NULL, NULL FROM n
  UNION ALL SELECT 'referential_integrity', orphan_count > 0, orphan_count || ' rows without a match of merchant_id',
    round(orphan_count / total_count, 6), NULL FROM o
  UNION ALL SELECT 'amount_range', true, (purchase_violations + refund_violations + chargeback_violations
    + p2p_violations) || ' amounts out of bounds', NULL, NULL FROM r
  UNION ALL SELECT 'duplicate_check', duplicate_count > 0, duplicate_count || ' surplus rows of an id',
    duplicate_count, NULL FROM d
  UNION ALL SELECT 'freshness_check', age > 2, 'Newest row: ' || printf('%.1f', age)
    || ' h ago, limit 2.0 h', round(age, 6), 2.0 FROM f
  UNION ALL SELECT 'transaction_type_check', false, 'Every type is known', NULL, NULL
)
SELECT check_name, CASE WHEN failed THEN 'FAIL' ELSE 'PASS' END AS status, message, metric_value, threshold,
  NOT failed AS passed, '2024-01-15' AS processing_date FROM checks"""
)

_ABSENT = """,
gaps AS (
  SELECT transaction_id AS event, card_hash,
    CASE WHEN CAST(transaction_id AS BIGINT) % 3 <> 0 THEN transaction_id END AS id,
    CASE WHEN CAST(transaction_id AS BIGINT) % 5 <> 1 THEN country_code END AS country,
    CASE WHEN CAST(transaction_id AS BIGINT) % 7 <> 2 THEN sec END AS at
  FROM txn
),
apart AS (
  SELECT DISTINCT a.card_hash FROM gaps a JOIN gaps b
    ON a.card_hash = b.card_hash AND a.id <> b.id AND a.country <> b.country AND b.at BETWEEN a.at - 3600 AND a.at
)"""

_VALIDATED = """,
raw AS (
  SELECT transaction_id, upper(currency[1:3]) AS currency, transaction_type,
    upper(country_code[1:(CASE WHEN transaction_type = 'p2p' THEN 3 ELSE 2 END)]) AS country_code,
    CASE WHEN response_code = '00' THEN merchant_category_code ELSE '51' END AS mcc,
    CASE WHEN transaction_type = 'refund' THEN -amount ELSE amount END AS amount
  FROM txn
)
SELECT transaction_id, currency, country_code, amount,
  concat_ws('|', CASE WHEN length(mcc) <> 4 THEN 'mcc_format' END,
    CASE WHEN length(country_code) <> 2 THEN 'country_format' END,
    CASE WHEN (transaction_type IN ('purchase', 'p2p') AND amount <= 0)
           OR (transaction_type IN ('refund', 'chargeback') AND amount >= 0) THEN 'amount_sign' END) AS failed_rules
FROM raw"""

ORACLES: dict[str, str] = {
    "fraud_geo_gaps": f"""{STREAM}{_ABSENT}
SELECT event, card_hash, card_hash IN (SELECT card_hash FROM apart) AS geo_hit,
  card_hash IN (SELECT card_hash FROM apart) AS geo_hit_as_busy FROM gaps""",
    "settlement": f"{LEDGER}, dated AS (SELECT *, '2024-01-15' AS processing_date FROM txn) {_SETTLEMENT}",
    "mcc_spending": f"""{LEDGER}
SELECT merchant_category_code, currency, count(*) AS txn_count, CAST(sum(abs(amount)) AS {_MONEY}) AS total_spend,
  CAST(sum(abs(amount)) AS DOUBLE) / count(*) AS avg_txn_amount, max(abs(amount)) AS max_txn_amount,
  count(DISTINCT merchant_id) AS active_merchant_count, count(DISTINCT card_hash) AS unique_cards,
  round(count(*) FILTER (response_code = '00') / count(*), 4) AS approval_rate, '2024-01-15' AS processing_date
FROM txn WHERE transaction_type IN ('purchase', 'p2p') GROUP BY merchant_category_code, currency""",
    "merchant_summary": f"""{LEDGER}
SELECT merchant_id, count(*) AS total_txns, count(*) FILTER (transaction_type = 'purchase') AS purchase_count,
  count(*) FILTER (transaction_type = 'refund') AS refund_count,
  count(*) FILTER (transaction_type = 'chargeback') AS chargeback_count,
  CAST(coalesce(sum(abs(amount)) FILTER (transaction_type = 'purchase'), 0) AS {_MONEY}) AS purchase_volume,
  round(count(*) FILTER (response_code = '00') / count(*), 4) AS approval_rate,
  count(DISTINCT card_hash) AS unique_cards, min_by(merchant_category_code, transaction_id) AS merchant_category_code,
  '2024-01-15' AS processing_date
FROM txn GROUP BY merchant_id""",
    "distinct_sketches": f"""{LEDGER}
SELECT merchant_category_code, currency, count(*) AS txn_count, count(DISTINCT card_hash) AS unique_cards,
  count(DISTINCT merchant_id) AS unique_merchants, true AS cards_ok, true AS merchants_ok
FROM txn GROUP BY merchant_category_code, currency""",
    "corridor_volume": f"""{LEDGER}
SELECT issuer_country, country_code AS merchant_country, currency,
  issuer_country || '→' || country_code AS corridor, count(*) AS txn_count,
  CAST(sum(abs(amount)) AS {_MONEY}) AS total_value, CAST(sum(abs(amount)) AS DOUBLE) / count(*) AS avg_amount,
  count(DISTINCT card_hash) AS unique_cards, count(DISTINCT merchant_id) AS unique_merchants,
  '2024-01-15' AS processing_date
FROM (
  SELECT txn.*, coalesce(n.n_name, country_code) AS issuer_country FROM txn
  LEFT JOIN places n ON n.r_name <> 'AFRICA' AND CAST(n.n_nationkey AS VARCHAR) = issuer_id
)
WHERE is_cross_border AND transaction_type IN ('purchase', 'p2p')
GROUP BY issuer_country, country_code, currency""",
    "chargeback_ratios": f"""{LEDGER},
good AS (SELECT merchant_id, count(*) AS n, sum(abs(amount)) AS v FROM txn
         WHERE transaction_type = 'purchase' GROUP BY 1),
bad AS (SELECT merchant_id, count(*) AS n, sum(abs(amount)) AS v FROM txn
        WHERE transaction_type = 'chargeback' GROUP BY 1)
SELECT g.merchant_id, s_name AS merchant_name, CAST(5000 + s_suppkey % 20 AS VARCHAR) AS merchant_category_code,
  g.n AS purchase_count, CAST(g.v AS {_MONEY}) AS purchase_volume, coalesce(b.n, 0) AS chargeback_count,
  CAST(coalesce(b.v, 0) AS {_MONEY}) AS chargeback_volume,
  round(coalesce(b.n, 0) / g.n, 6) AS chargeback_ratio_count,
  round(CAST(coalesce(b.v, 0) AS DOUBLE) / CAST(g.v + coalesce(b.v, 0) AS DOUBLE), 6) AS chargeback_ratio_value,
  coalesce(b.n, 0) / g.n > 0.5 AS is_flagged, CAST(0.5 AS DOUBLE) AS threshold_applied,
  '2024-01-15' AS processing_date
FROM good g LEFT JOIN bad b ON b.merchant_id = g.merchant_id
LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = g.merchant_id""",
    "fraud_velocity": f"{_SCORED} SELECT transaction_id, card_hash, velocity_count, fraud_velocity FROM scored",
    "fraud_amount": f"""{_SCORED}
SELECT transaction_id, card_hash, CAST(amount AS DOUBLE) AS amount_dbl, round(mean, 6) AS rolling_avg,
  prior_sample_count, fraud_amount_anomaly FROM scored""",
    "fraud_geo": f"{_SCORED} SELECT transaction_id, card_hash, country_code, fraud_geo_impossibility FROM scored",
    "multi_country_cards": f"{_SCORED} SELECT card_hash FROM conflicts",
    "fraud_all": f"{_SCORED} SELECT {_SCORED_COLUMNS} FROM scored",
    "fraud_all_busy_cards": f"{_SCORED} SELECT {_SCORED_COLUMNS} FROM scored",
    "fraud_hot_second": f"""{STREAM},
heated AS (
  SELECT transaction_id, amount, CASE WHEN n % 3 = 0 THEN 'hot' ELSE card_hash END AS card_hash,
    CASE WHEN n % 8 = 1 THEN NULL WHEN n % 3 = 0 THEN TIMESTAMP '2024-01-10 12:00:00' + (n % 9 // 3) * INTERVAL 1 SECOND
         ELSE "timestamp" END AS "timestamp"
  FROM (SELECT *, CAST(transaction_id AS BIGINT) AS n FROM txn)
),
history AS (
  SELECT *, count(*) OVER prior AS prior_sample_count, CAST(sum(amount) OVER prior AS DOUBLE) / count(*) OVER prior AS mean,
    count(*) OVER (PARTITION BY card_hash ORDER BY CAST(floor(epoch("timestamp")) AS BIGINT) NULLS FIRST
                   RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS velocity_count
  FROM heated
  WINDOW prior AS (PARTITION BY card_hash ORDER BY "timestamp" NULLS FIRST, transaction_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT transaction_id, card_hash, round(mean, 6) AS rolling_avg, prior_sample_count,
  coalesce(prior_sample_count >= 3 AND CAST(amount AS DOUBLE) > mean * 3.0, false) AS fraud_amount_anomaly,
  velocity_count, velocity_count > 5 AS fraud_velocity FROM history""",
    "fraud_flagged_only": f"{_SCORED} SELECT {_SCORED_COLUMNS} FROM scored WHERE is_fraud_flagged",
    "merchant_volume_5min": f"{STREAM}, {_MERCHANT_VOLUME} SELECT * FROM volumes",
    "issuer_xborder_1h": f"{STREAM}, {_XBORDER} SELECT * FROM ratios",
    "issuer_xborder_50_20": f"{STREAM}, {_XBORDER_50_20} SELECT * FROM ratios",
    "card_daily": STREAM + _CARD_DAILY,
    "dq_nulls": f"""{LEDGER}{_GAPS}
SELECT count(*) - count(transaction_id) AS null_count_transaction_id, count(*) - count(amount) AS null_count_amount,
  count(*) - count("timestamp") AS null_count_timestamp, count(*) - count(card_hash) AS null_count_card_hash,
  count(*) - count(merchant_id) AS null_count_merchant_id FROM gappy""",
    "dq_referential": LEDGER + _orphans("txn"),
    "dq_amount_ranges": LEDGER + _ranges("txn"),
    "dq_duplicates": f"{LEDGER} {_DUPLICATES} txn",
    "dq_freshness": f"""{STREAM}
SELECT max("timestamp") AS latest, round(epoch(TIMESTAMP '2024-02-01' - max("timestamp")) / 3600, 6) AS age_hours
FROM txn""",
    "dq_transaction_types": f"""{LEDGER}
SELECT CASE WHEN currency = 'ASIA' THEN 'wire_transfer' END AS transaction_type, count(*) AS row_count
FROM txn WHERE transaction_type = 'p2p' AND currency IN ('ASIA', 'AFRICA') GROUP BY 1""",
    "dq_report": _REPORT,
    "dq_gate": f"""{LEDGER},
r AS ({_ranges("txn")}), o AS ({_orphans("txn")}), d AS ({_DUPLICATES} txn),
failed AS (
  SELECT CAST(purchase_violations + refund_violations + chargeback_violations + p2p_violations > 0 AS BIGINT)
    + CAST(orphan_count > 0 AS BIGINT) + CAST(duplicate_count > 0 AS BIGINT) + 1 AS n FROM r, o, d
)
SELECT '2024-01-15' AS processing_date, CAST(7 AS BIGINT) AS check_count, n AS fail_count,
  n = 0 AS gate_passed FROM failed
UNION ALL SELECT '2024-01-30', 7, 0, true
UNION ALL SELECT '2024-01-31', 0, 0, false""",
    "json_parse": f"""{STREAM}
SELECT transaction_id, card_hash, amount, "timestamp", transaction_type, is_cross_border, NULL AS corrupt_text
FROM txn WHERE response_code <> '51'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, '#' || transaction_id FROM txn WHERE response_code = '51'""",
    "kafka_encode": f"""{STREAM}
SELECT card_hash AS key, transaction_id, CAST(amount AS VARCHAR) AS amount,
  strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp", transaction_type,
  CAST(is_cross_border AS VARCHAR) AS is_cross_border FROM txn""",
    "landing_scan": f"""{STREAM}
SELECT transaction_id, card_hash, amount, "timestamp", is_cross_border,
  strftime("timestamp", '%Y-%m-%d') AS date, CAST(hour("timestamp") AS INTEGER) AS hour FROM txn""",
    "filtered_scan": """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem
WHERE l_quantity >= 30 AND l_returnflag = 'N' AND l_discount < 0.05""",
    "processed_zone": f"""{STREAM}
SELECT transaction_id, card_hash, merchant_id, amount, transaction_type, strftime("timestamp", '%Y-%m-%d') AS date
FROM txn""",
    "settlement_roundtrip": f"""{LEDGER},
dated AS (
  SELECT *, CASE WHEN "timestamp" < TIMESTAMP '2000-01-01' THEN '2024-01-15' ELSE '2024-01-16' END AS processing_date
  FROM txn
) {_SETTLEMENT}""",
    "validate_rows": STREAM + _VALIDATED,
    "stream_validated": STREAM + _VALIDATED,
    "response_breakdown": f"""{LEDGER}
SELECT response_code, CASE response_code WHEN '00' THEN 'APPROVED' WHEN '51' THEN 'INSUFFICIENT_FUNDS' END
  AS response_label, response_code = '00' AS is_approved, count(*) AS txn_count,
  CAST(sum(abs(amount)) AS {_MONEY}) AS total_value
FROM txn GROUP BY response_code""",
    "card_tokenize": "SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS card_hash FROM events",
    # An append stream withholds the windows its watermark has not passed.
    "stream_merchant_volume": f"""{STREAM}, {_MERCHANT_VOLUME}
SELECT * FROM volumes WHERE window_end <= (
  SELECT max("timestamp") FROM txn WHERE transaction_type IN ('purchase', 'p2p')) - INTERVAL '10 minutes'""",
    "stream_issuer_xborder": f"""{STREAM}, {_XBORDER}
SELECT * FROM ratios WHERE window_end <= (SELECT max("timestamp") FROM txn) - INTERVAL '15 minutes'""",
    "stream_issuer_xborder_50_20": f"""{STREAM}, {_XBORDER_50_20}
SELECT * FROM ratios WHERE window_end <= (SELECT max("timestamp") FROM txn) - INTERVAL '15 minutes'""",
    "stream_card_daily": STREAM + _CARD_DAILY,
    "stream_card_closed": STREAM + _CARD_DAILY,
    "stream_fraud_batches": f"""{_SCORED}
SELECT transaction_id, card_hash, transaction_type, fraud_reasons FROM scored WHERE is_fraud_flagged""",
    "stream_card_alerts": f"""{STREAM},
seconds AS (
  SELECT card_hash, sec, count(*) AS txn_count, sum(amount) AS total, max(amount) AS largest
  FROM txn GROUP BY card_hash, sec
),
hits AS (
  SELECT a.card_hash, min(a.sec) AS since FROM txn a JOIN txn b
    ON a.card_hash = b.card_hash AND a.transaction_id <> b.transaction_id
   AND a.country_code <> b.country_code AND b.sec BETWEEN a.sec - 300 AND a.sec
  GROUP BY a.card_hash
),
history AS (
  SELECT *, CAST(sum(txn_count) OVER (PARTITION BY card_hash ORDER BY sec
      RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS BIGINT) AS velocity_count,
    CAST(coalesce(sum(txn_count) OVER prior, 0) AS BIGINT) AS prior_sample_count,
    CAST(sum(total) OVER prior AS DOUBLE) / sum(txn_count) OVER prior AS mean
  FROM seconds
  WINDOW prior AS (PARTITION BY card_hash ORDER BY sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT h.card_hash, make_timestamp(sec * 1000000) AS second, txn_count, velocity_count, prior_sample_count,
  round(mean, 6) AS rolling_avg, velocity_count > 5 AS fraud_velocity,
  coalesce(prior_sample_count >= 3 AND CAST(largest AS DOUBLE) > mean * 3.0, false) AS fraud_amount_anomaly,
  coalesce(sec >= since, false) AS fraud_geo_impossibility
FROM history h LEFT JOIN hits ON hits.card_hash = h.card_hash
WHERE make_timestamp((sec + 1) * 1000000) <= (SELECT max("timestamp") FROM txn) - INTERVAL '10 minutes'""",
    "stream_landing": f"""{STREAM}
SELECT transaction_id, amount, "timestamp", strftime("timestamp", '%Y-%m-%d') AS date,
  CAST(hour("timestamp") AS INTEGER) AS hour FROM txn""",
    "landing_mixed": f"""{STREAM}
SELECT transaction_id, amount, "timestamp", strftime("timestamp", '%Y-%m-%d') AS date,
  CAST(hour("timestamp") AS INTEGER) AS hour, CAST("timestamp" AS DATE) = DATE '2024-01-15' AS of_date FROM txn""",
    "stream_replayed": f"""{STREAM}
SELECT transaction_id, card_hash, amount, "timestamp" FROM txn""",
}
