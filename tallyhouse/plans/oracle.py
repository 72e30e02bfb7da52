"""The same results as plain SQL over the source tables, for checking with DuckDB."""

from __future__ import annotations

import re

from ..schemas import (
    CATEGORY_MISSING,
    CATEGORY_OTHER,
    CATEGORY_RULES,
    FREQUENCY_BANDS,
    FREQUENCY_OTHER,
    RECENCY_BANDS,
    RECENCY_OTHER,
    TIER_BANDS,
    TIER_LOW,
    TIER_NONE,
    VALUE_BANDS,
    VALUE_OTHER,
)

SOURCE = "invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"



def _bands(value: str, comparison: str, bands, other: str | None) -> str:
    """CASE over bands in order; `other` None leaves the rest NULL."""
    cases = " ".join(f"WHEN {value} {comparison} {bound} THEN '{label}'" for bound, label in bands)
    return f"CASE {cases} " + (f"ELSE '{other}' END" if other else "END")


# Named building blocks; a query gets the ones it mentions, in this order.
BLOCKS: dict[str, str] = {}

BLOCKS["raw_lines"] = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS bronze_id,
  (CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'C' ELSE '' END) || CAST(l_orderkey AS VARCHAR) AS invoice,
  CASE WHEN l_partkey % 97 = 0 THEN '' ELSE ' ' || CAST(l_partkey AS VARCHAR) || ' ' END AS stock_code,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE ' ' || p_name || (CASE l_partkey % 12
    WHEN 0 THEN ' xmas' WHEN 1 THEN ' christmas' WHEN 2 THEN ' birthday' WHEN 3 THEN ' bag'
    WHEN 4 THEN ' heart' WHEN 5 THEN ' retro' WHEN 6 THEN ' lunch' ELSE '' END) END AS description,
  CASE WHEN l_suppkey % 53 = 0 THEN '0' WHEN l_suppkey % 47 = 0 THEN '12.5' WHEN l_suppkey % 43 = 0 THEN '80995'
    ELSE (CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END) || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
  CASE WHEN l_orderkey % 211 = 0 THEN 'nan' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' '
    || lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':26:00' END AS invoice_date,
  CASE WHEN l_partkey % 101 = 0 THEN '-11062.06' WHEN l_partkey % 89 = 0 THEN '0'
    ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS unit_price,
  CASE WHEN o_custkey % 4 = 0 THEN 'nan' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
  ' ' || lower(n_name) || ' ' AS country,
  CAST(o_orderdate AS TIMESTAMP) AS load_timestamp,
  'BATCH_' || strftime(o_orderdate, '%Y%m') AS load_batch_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""

_HASH = "md5(concat_ws('|', " + ", ".join(f"coalesce({c.strip()}, 'nan')" for c in SOURCE.split(",")) + "))"

BLOCKS["bronze"] = f"SELECT *, {_HASH} AS record_hash FROM raw_lines"

BLOCKS["cast_lines"] = r"""
SELECT bronze_id, trim(invoice) AS invoice_number, trim(stock_code) AS stock_code,
  CASE WHEN trim(description) NOT IN ('nan', 'None', 'NaN', '') THEN trim(description) END AS product_description,
  CASE WHEN regexp_matches(quantity, '^-?[0-9]+$') THEN TRY_CAST(quantity AS INTEGER) END AS quantity,
  CASE WHEN regexp_matches(unit_price, '^[0-9]+\.?[0-9]*$') THEN TRY_CAST(unit_price AS DECIMAL(10,2)) END AS unit_price,
  TRY_CAST(CASE WHEN invoice_date NOT IN ('nan', 'None', 'NaN', '') THEN invoice_date END AS TIMESTAMP) AS invoice_timestamp,
  CASE WHEN customer_id NOT IN ('nan', 'None', 'NaN', '') THEN customer_id END AS customer_id,
  trim(upper(country)) AS country, load_timestamp, load_batch_id, record_hash
FROM bronze"""

BLOCKS["typed"] = """
SELECT *, CAST(quantity * unit_price AS DECIMAL(15,2)) AS line_total,
  CAST(invoice_timestamp AS DATE) AS invoice_date,
  CAST(year(invoice_timestamp) AS INTEGER) AS invoice_year, CAST(month(invoice_timestamp) AS INTEGER) AS invoice_month,
  CAST(dayofweek(invoice_timestamp) AS INTEGER) AS invoice_day_of_week,
  CAST(hour(invoice_timestamp) AS INTEGER) AS invoice_hour,
  coalesce(quantity < 0, FALSE) AS is_return,
  coalesce(starts_with(invoice_number, 'C'), FALSE) AS is_cancelled,
  (invoice_number IS NOT NULL AND stock_code IS NOT NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL
    AND invoice_timestamp IS NOT NULL AND country IS NOT NULL) AS is_complete_record,
  customer_id IS NOT NULL AS has_customer_id,
  coalesce(length(product_description) > 0, FALSE) AS has_product_description,
  coalesce(quantity > 0 AND unit_price > 0, FALSE) AS is_valid_transaction
FROM cast_lines"""

BLOCKS["silver"] = """
SELECT * FROM typed WHERE invoice_number IS NOT NULL AND stock_code IS NOT NULL AND stock_code <> ''
  AND invoice_timestamp IS NOT NULL AND quantity IS NOT NULL AND quantity <> 0
  AND quantity BETWEEN -10000 AND 10000 AND unit_price IS NOT NULL AND unit_price >= 0"""

BLOCKS["sales"] = """
SELECT * FROM silver WHERE customer_id IS NOT NULL AND is_valid_transaction AND NOT is_return AND NOT is_cancelled"""

BLOCKS["customer_country"] = """
SELECT customer_id, country, count(DISTINCT invoice_number) AS total_orders, count(*) AS total_line_items,
  CAST(sum(line_total) AS DOUBLE) AS total_lifetime_value,
  CAST(sum(line_total) AS DOUBLE) / count(*) AS avg_line_item_value,
  CAST(sum(quantity) AS BIGINT) AS total_units_purchased,
  min(invoice_date) AS first_purchase_date, max(invoice_date) AS last_purchase_date,
  CAST(date_diff('day', min(invoice_date), max(invoice_date)) AS INTEGER) AS customer_tenure_days
FROM sales GROUP BY customer_id, country"""

BLOCKS["order_value_rows"] = """
SELECT customer_id, invoice_number, sum(line_total) AS order_value FROM sales GROUP BY customer_id, invoice_number"""

BLOCKS["order_stats"] = """
SELECT customer_id, CAST(sum(order_value) AS DOUBLE) / count(*) AS avg_order_value,
  CAST(max(order_value) AS DOUBLE) AS max_order_value, CAST(min(order_value) AS DOUBLE) AS min_order_value,
  round(stddev_samp(CAST(order_value AS DOUBLE)), 3) AS stddev_order_value
FROM order_value_rows GROUP BY customer_id"""

BLOCKS["customer_full"] = """
SELECT a.*, s.avg_order_value, s.max_order_value, s.min_order_value, s.stddev_order_value,
  CASE WHEN a.total_orders > 1 THEN CAST(a.customer_tenure_days AS DOUBLE) / (a.total_orders - 1) END AS avg_days_between_orders
FROM customer_country a LEFT JOIN order_stats s ON a.customer_id = s.customer_id"""

BLOCKS["dim_customer"] = f"""
SELECT md5(customer_id) AS customer_key, customer_id, country, total_orders, total_line_items, total_units_purchased,
  total_lifetime_value, avg_order_value, max_order_value, min_order_value, avg_line_item_value,
  avg_days_between_orders, first_purchase_date, last_purchase_date, customer_tenure_days,
  frequency_segment, value_segment, recency_segment,
  recency_segment[1] || '-' || frequency_segment[1] || '-' || value_segment[1] AS rfm_segment, TRUE AS is_current
FROM (SELECT *,
    {_bands('total_orders', '>=', FREQUENCY_BANDS, FREQUENCY_OTHER)} AS frequency_segment,
    {_bands('total_lifetime_value', '>=', VALUE_BANDS, VALUE_OTHER)} AS value_segment,
    {_bands("(DATE '2001-09-01' - last_purchase_date)", '<=', RECENCY_BANDS, RECENCY_OTHER)} AS recency_segment
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
          ORDER BY total_orders DESC, total_lifetime_value DESC, country) AS pick FROM customer_full)
  WHERE pick = 1)"""


def _metrics(lines: str) -> str:
    return f"""
SELECT stock_code, max(product_description) AS product_description,
  count(DISTINCT CASE WHEN NOT is_return THEN customer_id END) AS unique_customers, count(*) AS total_transactions,
  CAST(sum(CASE WHEN NOT is_return THEN quantity ELSE 0 END) AS BIGINT) AS total_units_sold,
  CAST(sum(CASE WHEN is_return THEN abs(quantity) ELSE 0 END) AS BIGINT) AS total_units_returned,
  CAST(sum(CASE WHEN NOT is_return THEN line_total ELSE 0 END) AS DOUBLE) AS total_revenue,
  CAST(sum(CASE WHEN NOT is_return THEN unit_price END) AS DOUBLE) / count(CASE WHEN NOT is_return THEN unit_price END) AS avg_unit_price,
  CAST(count(CASE WHEN is_return THEN 1 END) AS BIGINT) AS return_count,
  count(DISTINCT country) AS countries_sold_in,
  min(invoice_date) AS first_sale_date, max(invoice_date) AS last_sale_date,
  CASE WHEN sum(CASE WHEN NOT is_return THEN quantity ELSE 0 END) > 0
    THEN CAST(sum(CASE WHEN is_return THEN abs(quantity) ELSE 0 END) AS DOUBLE)
      / CAST(sum(CASE WHEN NOT is_return THEN quantity ELSE 0 END) AS DOUBLE) * 100 ELSE 0.0 END AS return_rate_percent,
  CAST(date_diff('day', min(invoice_date), max(invoice_date)) AS INTEGER) AS days_available,
  CAST(sum(CASE WHEN NOT is_return THEN quantity ELSE 0 END) AS DOUBLE) / count(*) AS avg_units_per_transaction
FROM {lines} GROUP BY stock_code"""


def _latest(where: str) -> str:
    return f"""
SELECT stock_code, product_description FROM (SELECT stock_code, product_description, row_number() OVER (
  PARTITION BY stock_code ORDER BY product_description IS NULL, invoice_timestamp DESC, product_description DESC) AS pick
  FROM silver WHERE {where}) WHERE pick = 1"""


def _dim_product(names: str, metrics: str) -> str:
    categories = " ".join(
        f"WHEN regexp_matches(upper(product_description), '{'|'.join(words)}') THEN '{label}'"
        for label, words in CATEGORY_RULES
    )
    return f"""
SELECT md5(stock_code) AS product_key, stock_code, coalesce(product_description, 'UNKNOWN PRODUCT') AS product_description,
  CASE WHEN coalesce(product_description, '') = '' THEN '{CATEGORY_MISSING}' {categories} ELSE '{CATEGORY_OTHER}' END AS product_category,
  {_bands('total_revenue', '>=', TIER_BANDS, None)[:-4]} WHEN total_revenue > 0 THEN '{TIER_LOW}' ELSE '{TIER_NONE}' END AS performance_tier,
  avg_unit_price, unique_customers, total_transactions, total_units_sold, total_units_returned, total_revenue,
  return_count, return_rate_percent, countries_sold_in, first_sale_date, last_sale_date, days_available,
  avg_units_per_transaction, TRUE AS is_current
FROM (SELECT n.stock_code, n.product_description, coalesce(avg_unit_price, 0) AS avg_unit_price,
    coalesce(unique_customers, 0) AS unique_customers, coalesce(total_transactions, 0) AS total_transactions,
    coalesce(total_units_sold, 0) AS total_units_sold, coalesce(total_units_returned, 0) AS total_units_returned,
    coalesce(total_revenue, 0) AS total_revenue, coalesce(return_count, 0) AS return_count,
    coalesce(return_rate_percent, 0) AS return_rate_percent, coalesce(countries_sold_in, 0) AS countries_sold_in,
    first_sale_date, last_sale_date, coalesce(days_available, 0) AS days_available,
    coalesce(avg_units_per_transaction, 0) AS avg_units_per_transaction
  FROM {names} n LEFT JOIN {metrics} m ON n.stock_code = m.stock_code)"""


BLOCKS["valid_lines"] = "SELECT * FROM silver WHERE is_valid_transaction"
BLOCKS["early_lines"] = "SELECT * FROM valid_lines WHERE invoice_date < DATE '1998-01-01'"
BLOCKS["metrics"] = _metrics("valid_lines")
BLOCKS["early_metrics"] = _metrics("early_lines")
BLOCKS["return_metrics"] = _metrics("silver")
BLOCKS["latest"] = _latest("TRUE")
BLOCKS["early_latest"] = _latest("invoice_date < DATE '1998-01-01'")
BLOCKS["dim_product"] = _dim_product("latest", "metrics")
BLOCKS["early_product"] = _dim_product("early_latest", "early_metrics")

BLOCKS["calendar"] = """
SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key
FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d)"""

BLOCKS["dim_geography"] = """
SELECT DISTINCT md5(s.country) AS geography_key, s.country, r_name AS region
FROM silver s LEFT JOIN nation ON trim(upper(n_name)) = s.country LEFT JOIN region ON n_regionkey = r_regionkey"""

BLOCKS["fact"] = """
SELECT md5(s.bronze_id) AS sale_key, d.date_key, p.product_key, c.customer_key, g.geography_key, s.invoice_number,
  s.quantity, CAST(s.unit_price AS DOUBLE) AS unit_price, s.line_total, 0 AS discount_amount, s.line_total AS net_amount,
  s.is_return, s.is_cancelled, s.is_valid_transaction, s.bronze_id AS source_bronze_id, s.load_timestamp, d.full_date
FROM silver s JOIN calendar d ON s.invoice_date = d.full_date
LEFT JOIN dim_product p ON s.stock_code = p.stock_code
LEFT JOIN dim_customer c ON s.customer_id = c.customer_id
LEFT JOIN dim_geography g ON s.country = g.country"""

BLOCKS["log_batches"] = """
SELECT load_batch_id AS batch_id, min(load_timestamp) AS started, max(load_timestamp) AS last_load, count(*) AS lines,
  count(*) FILTER (WHERE invoice_date = 'nan') AS lost FROM bronze GROUP BY load_batch_id"""

BLOCKS["log_now"] = """
SELECT batch_id, CASE WHEN lost * 200 > lines THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  started AS ingestion_start_time, last_load + INTERVAL 1 HOUR AS ingestion_end_time, lines AS records_processed,
  lines - lost AS records_inserted, lost AS records_failed,
  date_diff('second', started, last_load + INTERVAL 1 HOUR) AS ingestion_duration_seconds FROM log_batches"""

BLOCKS["profile"] = """
SELECT *, CASE WHEN quantity IS NULL THEN quantity_text END AS quantity_unfit,
  CASE WHEN unit_price IS NULL THEN unit_price_text END AS unit_price_unfit,
  CAST(quantity AS DECIMAL(38,6)) * CAST(unit_price AS DECIMAL(38,6)) AS revenue
FROM (SELECT nullif(invoice, 'nan') AS invoice, nullif(stock_code, 'nan') AS stock_code, nullif(description, 'nan') AS description,
  nullif(quantity, 'nan') AS quantity_text, nullif(unit_price, 'nan') AS unit_price_text,
  CASE WHEN CAST(TRY_CAST(quantity AS DECIMAL(18,6)) AS DOUBLE) = TRY_CAST(quantity AS DOUBLE)
    THEN TRY_CAST(quantity AS DECIMAL(18,6)) END AS quantity,
  CASE WHEN CAST(TRY_CAST(unit_price AS DECIMAL(18,6)) AS DOUBLE) = TRY_CAST(unit_price AS DOUBLE)
    THEN TRY_CAST(unit_price AS DECIMAL(18,6)) END AS unit_price,
  TRY_CAST(nullif(invoice_date, 'nan') AS TIMESTAMP) AS invoice_date, nullif(customer_id, 'nan') AS customer_id,
  nullif(country, 'nan') AS country, load_timestamp, 'lineitem' AS source_file_name FROM bronze)"""



def _as_text(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce({text}, {column}_unfit)" if column in ("quantity", "unit_price") else text


BLOCKS["profile_counts"] = " UNION ALL ".join(
    f"SELECT '{c.strip()}' AS column_name, {_as_text(c.strip())} AS value, count(*) AS n FROM profile GROUP BY 2"
    for c in SOURCE.split(",")
)

BLOCKS["numeric_stats"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
  round(CAST(CAST(sum({c}) AS VARCHAR) AS DOUBLE) / count({c}), 4) AS mean, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median,
  round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std_dev, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q1,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q3, count(*) FILTER (WHERE {c} = 0) AS zero_count,
  count(*) FILTER (WHERE {c} < 0) AS negative_count, count(*) FILTER (WHERE {c} > 0) AS positive_count,
  count({c}_unfit) AS unfit_count, count(*) AS total_rows FROM profile"""
    for c in ("quantity", "unit_price")
)

BLOCKS["column_stats"] = """
SELECT column_name, CAST(sum(n) FILTER (WHERE value IS NOT NULL) AS BIGINT) AS non_null_count,
  CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS null_count,
  coalesce(sum(n) FILTER (WHERE value IS NULL), 0)::DOUBLE / sum(n)::DOUBLE * 100 AS null_percentage,
  count(value) AS unique_count, count(value)::DOUBLE / sum(n)::DOUBLE * 100 AS unique_percentage
FROM profile_counts GROUP BY column_name"""

BLOCKS["copies"] = """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_records FROM (SELECT count(*) AS n FROM profile
  GROUP BY invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country, load_timestamp, source_file_name,
  quantity_unfit, unit_price_unfit)"""

_PROFILE_COLUMNS = [c.strip() for c in SOURCE.split(",")] + ["load_timestamp", "source_file_name"]

BLOCKS["quality"] = (
    "SELECT count(*) AS total_records, count(*) FILTER (WHERE unit_price < 0) AS negative_prices, "
    "count(*) FILTER (WHERE quantity = 0) AS zero_quantities, "
    + ", ".join(f"count(*) - count({_as_text(c)}) AS null_{c}" for c in _PROFILE_COLUMNS)
    + ", (SELECT duplicate_records FROM copies) AS duplicate_records FROM profile"
)

_NULL_SUM = " + ".join(f"null_{c}" for c in _PROFILE_COLUMNS)

BLOCKS["score_parts"] = f"""
SELECT *, (total_records * 10 - ({_NULL_SUM}))::DOUBLE / (total_records * 10) * 100 AS completeness,
  (total_records * 2 - negative_prices - zero_quantities)::DOUBLE / (total_records * 2) * 100 AS validity,
  CASE WHEN duplicate_records > 0 THEN 90.0::DOUBLE ELSE 100.0::DOUBLE END AS consistency FROM quality"""

_CRITICAL = ("invoice", "stock_code", "quantity", "unit_price", "country")

BLOCKS["issues"] = " UNION ALL ".join(
    [
        f"SELECT 'completeness' AS type, 'critical' AS severity, '{c}' AS column_name, "
        f"printf('High null percentage in critical column: %.1f%%', null_{c}::DOUBLE / total_records * 100) AS description "
        f"FROM quality WHERE null_{c}::DOUBLE / total_records * 100 > 5"
        for c in _CRITICAL
    ]
    + [
        "SELECT 'validity', 'high', 'unit_price', printf('Found %d records with negative prices', negative_prices) FROM quality WHERE negative_prices > 0",
        "SELECT 'validity', 'medium', 'quantity', printf('Found %d records with zero quantity', zero_quantities) FROM quality WHERE zero_quantities > 0",
        "SELECT 'consistency', 'medium', NULL, printf('Found %d duplicate records', duplicate_records) FROM quality WHERE duplicate_records > 0",
    ]
)

BLOCKS["scores"] = """
SELECT total_records, (completeness + validity + consistency) / 3 AS overall_score, completeness AS completeness_score,
  validity AS validity_score, consistency AS consistency_score,
  (SELECT count(*) FROM issues WHERE severity = 'critical') AS critical_issues,
  (SELECT count(*) FROM issues WHERE severity = 'high') AS high_issues,
  (SELECT count(*) FROM issues WHERE severity = 'medium') AS medium_issues, CAST(0 AS BIGINT) AS low_issues FROM score_parts"""

BODIES: dict[str, str] = {}

BODIES["bronze_raw"] = (
    f"SELECT bronze_id, {SOURCE}, load_batch_id, 'UCI_ML_REPO' AS source_system, FALSE AS is_deleted FROM bronze"
)
BODIES["record_hash"] = "SELECT bronze_id, record_hash FROM bronze"
BODIES["duplicate_hashes"] = "SELECT record_hash, count(*) AS copies FROM bronze GROUP BY record_hash HAVING count(*) > 1"
BODIES["dedupe_records"] = f"""
SELECT bronze_id, record_hash, {SOURCE} FROM (SELECT *, row_number() OVER (PARTITION BY record_hash
  ORDER BY load_timestamp, bronze_id) AS pick FROM bronze) WHERE pick = 1"""
BODIES["csv_roundtrip"] = """
SELECT count(*) AS left_rows, count(*) AS right_rows, TRUE AS columns_match, CAST(0 AS BIGINT) AS only_left,
  CAST(0 AS BIGINT) AS only_right, TRUE AS identical FROM bronze"""
BODIES["bronze_load"] = """
SELECT 'BATCH_20010901_060000_00000000' AS load_batch_id,
  'BRONZE_INGESTION_BATCH_20010901_060000_00000000' AS ingestion_process_id, 'UCI_ML_REPO' AS source_system,
  DATE '2001-09-01' AS load_date, FALSE AS is_deleted, count(*) AS records_loaded, count(*) AS bronze_ids,
  count(DISTINCT record_hash) AS record_hashes, count(*) AS with_file_name FROM bronze"""
BODIES["stream_ingest"] = f"SELECT DISTINCT record_hash, {SOURCE} FROM bronze"
BODIES["source_rejects"] = """
SELECT invoice, count(*) FILTER (NOT broken) AS n_lines,
  first(stock_code ORDER BY place) FILTER (NOT broken) AS first_code, last(stock_code ORDER BY place) FILTER (NOT broken) AS last_code,
  last(country ORDER BY place) FILTER (NOT broken) AS last_country, count(*) FILTER (broken) AS n_rejected,
  CASE WHEN count(*) FILTER (broken) > 0 THEN 'not 8 fields' END AS reason
FROM (SELECT invoice, nullif(stock_code, '') AS stock_code, country, CAST(string_split(bronze_id, '-')[1] AS INTEGER) % 23 = 0 AS broken,
    [CAST(string_split(bronze_id, '-')[2] AS INTEGER), CAST(string_split(bronze_id, '-')[3] AS INTEGER),
     CAST(string_split(bronze_id, '-')[4] AS INTEGER)] AS place FROM bronze)
GROUP BY invoice"""
BODIES["stream_layers"] = """
SELECT CAST(strftime(invoice_date, '%Y%m') AS INTEGER) AS sale_month, count(*) AS n_lines,
  CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(line_total) AS DOUBLE) AS line_total, count(DISTINCT load) AS loads
FROM (SELECT DISTINCT record_hash, invoice_date, quantity, line_total, CAST(string_split(bronze_id, '-')[1] AS INTEGER) % 2 AS load
  FROM silver) GROUP BY 1"""
BODIES["ingestion_log_current"] = "SELECT * FROM log_now"
BODIES["latest_load"] = """
SELECT batch_id FROM log_now WHERE status = 'SUCCESS' ORDER BY ingestion_start_time DESC, batch_id DESC LIMIT 1"""
BODIES["recent_rows"] = """
SELECT bronze_id, invoice, stock_code, load_timestamp FROM bronze ORDER BY load_timestamp DESC, bronze_id LIMIT 1000"""

BODIES["silver_clean"] = """
SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total) FROM silver"""
BODIES["silver_rejects"] = """
SELECT bronze_id, invoice_number, stock_code, quantity, CAST(unit_price AS DOUBLE) AS unit_price, concat_ws(',',
  CASE WHEN invoice_number IS NULL THEN 'missing_invoice' END,
  CASE WHEN stock_code IS NULL OR stock_code = '' THEN 'missing_stock_code' END,
  CASE WHEN invoice_timestamp IS NULL THEN 'missing_timestamp' END,
  CASE WHEN quantity IS NULL THEN 'missing_quantity' END,
  CASE WHEN quantity = 0 THEN 'zero_quantity' END,
  CASE WHEN quantity NOT BETWEEN -10000 AND 10000 THEN 'quantity_out_of_bounds' END,
  CASE WHEN unit_price IS NULL THEN 'missing_price' END,
  CASE WHEN unit_price < 0 THEN 'negative_price' END) AS reject_reasons
FROM typed WHERE bronze_id NOT IN (SELECT bronze_id FROM silver)"""
BODIES["quality_flags"] = """
SELECT is_return, is_cancelled, is_complete_record, has_customer_id, has_product_description, is_valid_transaction,
  count(*) AS n FROM typed GROUP BY ALL"""
BODIES["line_numbers"] = """
SELECT bronze_id, invoice_number AS invoice, stock_code, product_description AS description, quantity, invoice_timestamp,
  CAST(unit_price AS DOUBLE) AS unit_price, customer_id, country, CAST(line_total AS DOUBLE) AS line_total, is_return,
  is_cancelled, has_customer_id, has_product_description AS has_valid_description,
  row_number() OVER (PARTITION BY invoice_number ORDER BY bronze_id) AS invoice_line_number FROM silver"""
# The tests of the silver lines, by name, and what breaks them.
_SILVER_TESTS = {f"not_null_{c}": f"{c} IS NULL" for c in (
    "bronze_id", "invoice_number", "stock_code", "quantity", "unit_price", "invoice_timestamp", "invoice_date", "country", "line_total")}
_SILVER_TESTS |= {
    "accepted_range_quantity": "quantity NOT BETWEEN -10000 AND 10000",
    "accepted_range_unit_price": "unit_price NOT BETWEEN 0 AND 50000",
}
BODIES["failing_rows"] = " UNION ALL ".join(
    f"SELECT 'stg_bronze__online_retail' AS table_name, '{name}' AS test_name, bronze_id FROM typed WHERE {broken}"
    for name, broken in _SILVER_TESTS.items()
) + """ UNION ALL SELECT 'online_retail_raw', 'unique_bronze_id', bronze_id FROM bronze
  WHERE bronze_id IN (SELECT bronze_id FROM bronze GROUP BY bronze_id HAVING count(*) > 1)"""
BODIES["segment_history"] = """
SELECT customer_id, frequency_segment, day AS effective_date, lead(day) OVER w AS expiration_date,
  lead(day) OVER w IS NULL AS is_current, CAST(row_number() OVER w AS INTEGER) AS version_number
FROM (SELECT *, lag(frequency_segment) OVER (PARTITION BY customer_id ORDER BY day) AS before FROM (
    SELECT customer_id, day, CASE WHEN count(*) >= 10 THEN 'Frequent' WHEN count(*) >= 5 THEN 'Regular'
      WHEN count(*) >= 2 THEN 'Occasional' ELSE 'One-time' END AS frequency_segment
    FROM (SELECT customer_id, invoice_number, min(invoice_date) AS ordered FROM silver WHERE customer_id IS NOT NULL GROUP BY 1, 2)
    JOIN (SELECT make_date(y::INTEGER, 1, 1) AS day FROM range(1996, 2002) AS r(y)) ON ordered < day GROUP BY 1, 2))
WHERE before IS DISTINCT FROM frequency_segment
WINDOW w AS (PARTITION BY customer_id ORDER BY day)"""
BODIES["contract_rejects"] = """
SELECT * FROM (SELECT bronze_id, concat_ws(',',
  CASE WHEN invoice_number IS NULL THEN 'invoice_number is null' END,
  CASE WHEN stock_code IS NULL THEN 'stock_code is null' END,
  CASE WHEN quantity IS NULL THEN 'quantity is null' END,
  CASE WHEN invoice_timestamp IS NULL THEN 'invoice_timestamp is null' END,
  CASE WHEN unit_price IS NULL THEN 'unit_price is null' END,
  CASE WHEN country IS NULL THEN 'country is null' END,
  CASE WHEN quantity = 0 THEN 'chk_quantity_not_zero' END,
  CASE WHEN unit_price < 0 THEN 'chk_unit_price_not_negative' END,
  CASE WHEN length(invoice_number) = 0 THEN 'chk_invoice_not_empty' END,
  CASE WHEN length(stock_code) = 0 THEN 'chk_stock_code_not_empty' END,
  CASE WHEN length(country) = 0 THEN 'chk_country_not_empty' END) AS broken_rules FROM typed) WHERE broken_rules <> ''"""

BODIES["customer_country_agg"] = "SELECT * FROM customer_country"
BODIES["order_values"] = (
    "SELECT customer_id, invoice_number, CAST(order_value AS DOUBLE) AS order_value FROM order_value_rows"
)
BODIES["customer_order_stats"] = "SELECT * FROM order_stats"
BODIES["customer_transactions"] = "SELECT * FROM customer_full"
BODIES["dim_customer"] = "SELECT * FROM dim_customer"
BODIES["rfm_counts"] = """
SELECT rfm_segment, recency_segment, frequency_segment, value_segment, count(*) AS customers,
  CAST(sum(CAST(total_lifetime_value AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_value FROM dim_customer GROUP BY ALL"""
BODIES["product_metrics"] = "SELECT * FROM metrics"
BODIES["product_returns"] = """
SELECT stock_code, total_units_sold, total_units_returned, return_count, return_rate_percent FROM return_metrics"""
BODIES["latest_description"] = "SELECT * FROM latest"
BODIES["dim_product"] = "SELECT * FROM dim_product"
BODIES["description_quality"] = """
SELECT stock_code, coalesce(length(product_description) > 0, FALSE) AS has_valid_description,
  CAST(coalesce(length(product_description), 0) AS INTEGER) AS description_length FROM latest"""

_CHANGED = " OR ".join(
    f"o.{c} IS DISTINCT FROM n.{c}" for c in ("product_description", "product_category", "performance_tier")
)
BODIES["scd2_product"] = f"""
SELECT o.stock_code, o.product_description, o.product_category, o.performance_tier, DATE '1998-01-01' AS effective_date,
  CASE WHEN n.stock_code IS NOT NULL AND ({_CHANGED}) THEN DATE '2001-09-01' END AS expiration_date,
  NOT (n.stock_code IS NOT NULL AND ({_CHANGED})) AS is_current, 1 AS version_number,
  md5(o.stock_code || '-1998-01-01') AS version_key
FROM early_product o LEFT JOIN dim_product n ON o.stock_code = n.stock_code
UNION ALL
SELECT n.stock_code, n.product_description, n.product_category, n.performance_tier, DATE '2001-09-01', NULL, TRUE,
  CASE WHEN o.stock_code IS NULL THEN 1 ELSE 2 END, md5(n.stock_code || '-2001-09-01')
FROM dim_product n LEFT JOIN early_product o ON o.stock_code = n.stock_code WHERE o.stock_code IS NULL OR {_CHANGED}"""

_SPAN = """(SELECT CAST(unnest(generate_series(date_trunc('year', (SELECT min(invoice_timestamp) FROM silver)),
  date_trunc('year', (SELECT max(invoice_timestamp) FROM silver)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS full_date)"""
BODIES["dim_date"] = f"""
SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(full_date) AS INTEGER) AS year_number,
  CAST(month(full_date) AS INTEGER) AS month_number, strftime(full_date, '%B') AS month_name,
  strftime(full_date, '%b') AS month_abbr, CAST(day(full_date) AS INTEGER) AS day_of_month,
  CAST(dayofyear(full_date) AS INTEGER) AS day_of_year, CAST(dayofweek(full_date) AS INTEGER) AS day_of_week,
  strftime(full_date, '%A') AS day_of_week_name, CAST(week(full_date) AS INTEGER) AS week_of_year,
  CAST(quarter(full_date) AS INTEGER) AS quarter_number, 'Q' || quarter(full_date) AS quarter_name,
  isoyear(full_date) || '-' || lpad(CAST(week(full_date) AS VARCHAR), 2, '0') AS iso_week,
  dayofweek(full_date) IN (0, 6) AS is_weekend, full_date = DATE '2001-09-01' AS is_current_day,
  CAST(year(full_date) AS INTEGER) AS fiscal_year, CAST(quarter(full_date) AS INTEGER) AS fiscal_quarter,
  CAST(month(full_date) AS INTEGER) AS fiscal_month FROM {_SPAN}"""
BODIES["date_flags"] = f"""
SELECT d.full_date, d.full_date = DATE '2001-09-01' AS is_current_day,
  date_trunc('month', d.full_date) = DATE '2001-09-01' AS is_current_month,
  date_trunc('quarter', d.full_date) = DATE '2001-07-01' AS is_current_quarter,
  date_trunc('year', d.full_date) = DATE '2001-01-01' AS is_current_year,
  b.full_date IS NOT NULL AS is_holiday,
  CASE WHEN b.full_date IS NOT NULL THEN 'Busiest day of ' || year(d.full_date) END AS holiday_name
FROM {_SPAN} d LEFT JOIN (SELECT full_date FROM (SELECT invoice_date AS full_date, row_number() OVER (
    PARTITION BY year(invoice_date) ORDER BY count(*) DESC, invoice_date DESC) AS pick FROM silver GROUP BY invoice_date)
  WHERE pick = 1) b ON b.full_date = d.full_date"""
BODIES["dim_geography"] = "SELECT * FROM dim_geography"
BODIES["fact_sales"] = """
SELECT * EXCLUDE (load_timestamp, full_date) REPLACE (CAST(line_total AS DOUBLE) AS line_total,
  CAST(net_amount AS DOUBLE) AS net_amount) FROM fact"""
BODIES["fact_incremental"] = """
SELECT sale_key, date_key, product_key, customer_key,
  CASE WHEN load_timestamp >= TIMESTAMP '1999-12-01' AND load_timestamp < TIMESTAMP '2000-01-01' THEN quantity * 2 ELSE quantity END AS quantity,
  CAST(CASE WHEN load_timestamp >= TIMESTAMP '1999-12-01' AND load_timestamp < TIMESTAMP '2000-01-01' THEN line_total * 2 ELSE line_total END AS DOUBLE) AS line_total
FROM fact"""
BODIES["fact_daily"] = """
SELECT date_key, product_key, geography_key,
  CAST(sum(CASE WHEN NOT is_return THEN quantity ELSE 0 END) AS BIGINT) AS total_quantity,
  CAST(sum(CASE WHEN NOT is_return THEN line_total ELSE 0 END) AS DOUBLE) AS total_sales_amount,
  count(*) FILTER (WHERE is_return) AS total_returns,
  CAST(sum(CASE WHEN is_return THEN abs(line_total) ELSE 0 END) AS DOUBLE) AS total_return_amount,
  CAST(sum(CASE WHEN is_return THEN -abs(line_total) ELSE line_total END) AS DOUBLE) AS net_sales_amount,
  count(DISTINCT customer_key) AS unique_customers, count(DISTINCT invoice_number) AS unique_invoices
FROM fact GROUP BY date_key, product_key, geography_key"""

def _orphans(dimension: str, key: str, parent: str, keep_nulls: bool = False) -> str:
    nulls = "" if keep_nulls else f" AND f.{key} IS NOT NULL"
    return (
        f"SELECT '{dimension}' AS name, count(*) AS orphans FROM fact f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = f.{key}){nulls}"
    )


def _counted(name: str, test: str) -> str:
    return f"SELECT '{name}' AS name, count(*) FILTER (WHERE {test}) AS orphans FROM fact"


_INTEGRITY = [
    _counted("product_key", "product_key IS NULL"),
    _orphans("product_key_invalid", "product_key", "(SELECT product_key FROM dim_product WHERE total_revenue > 0)"),
    _orphans("date_key", "date_key", "(SELECT date_key FROM calendar WHERE date_key < 20010101)", keep_nulls=True),
    _orphans("customer_key_invalid", "customer_key", "(SELECT customer_key FROM dim_customer WHERE total_orders > 1)"),
]
BODIES["referential_integrity"] = (
    "SELECT name AS dimension, orphans AS orphan_count, CAST(sum(orphans) OVER () AS BIGINT) AS total_orphans FROM ("
    + " UNION ALL ".join(_INTEGRITY)
    + ") QUALIFY orphans > 0"
)

_CHECKS = [
    _counted("Orphaned Product Keys", "product_key IS NULL"),
    _orphans("Referential Integrity - Products", "product_key", "dim_product"),
    _orphans("Referential Integrity - Customers", "customer_key", "dim_customer"),
    _orphans("Referential Integrity - Dates", "date_key", "calendar", keep_nulls=True),
    _counted("Revenue Calculation Check", "abs(line_total - quantity * CAST(unit_price AS DECIMAL(10,2))) > 0.01"),
    _counted("Negative Unit Prices", "unit_price < 0"),
    _counted("NULL Required Fields (Fact)", "date_key + quantity + unit_price + line_total IS NULL"),
]
BODIES["pipeline_checks"] = (
    "SELECT name AS check_name, orphans AS failed_records, "
    "CASE WHEN orphans = 0 THEN '✅ PASS' ELSE '❌ FAIL' END AS status FROM (" + " UNION ALL ".join(_CHECKS) + ")"
)

_MEAN = "CAST(sum(CAST(total_lifetime_value AS DECIMAL(18,2))) AS DOUBLE) / count(*)"
BODIES["layer_summary"] = f"""
SELECT 'BRONZE' AS layer, 'online_retail_raw' AS table_name, count(*)::VARCHAR AS record_count,
  count(DISTINCT load_batch_id)::VARCHAR AS metric_2, min(load_timestamp)::VARCHAR AS metric_3,
  max(load_timestamp)::VARCHAR AS metric_4 FROM bronze
UNION ALL SELECT 'SILVER', 'stg_bronze__online_retail', count(*)::VARCHAR, count(DISTINCT invoice_number)::VARCHAR,
  min(invoice_date)::VARCHAR, max(invoice_date)::VARCHAR FROM silver
UNION ALL SELECT 'GOLD', 'dim_customer', count(*)::VARCHAR, CAST(round({_MEAN}, 2) AS DECIMAL(20,2))::VARCHAR,
  min(first_purchase_date)::VARCHAR, max(last_purchase_date)::VARCHAR FROM dim_customer
UNION ALL SELECT 'GOLD', 'dim_product', count(*)::VARCHAR, sum(CAST(total_revenue AS DECIMAL(18,2)))::VARCHAR,
  min(first_sale_date)::VARCHAR, max(last_sale_date)::VARCHAR FROM dim_product
UNION ALL SELECT 'GOLD', 'dim_date', count(*)::VARCHAR, min(year(full_date))::VARCHAR, min(full_date)::VARCHAR,
  max(full_date)::VARCHAR FROM calendar
UNION ALL SELECT 'GOLD', 'fact_sales', count(*)::VARCHAR, sum(line_total)::VARCHAR, min(date_key)::VARCHAR,
  max(date_key)::VARCHAR FROM fact"""
BODIES["orphan_codes"] = """
SELECT stock_code, count(*) AS occurrence_count FROM silver WHERE stock_code NOT IN (SELECT stock_code FROM dim_product
  WHERE performance_tier <> 'Star Product') GROUP BY stock_code ORDER BY occurrence_count DESC, stock_code LIMIT 10"""
BODIES["orphan_summary"] = """
SELECT count(*) AS total_orphans, count(DISTINCT invoice_number) AS affected_invoices FROM fact
WHERE product_key NOT IN (SELECT product_key FROM dim_product WHERE performance_tier = 'Star Product')"""


def _result(check: str, table: str, column: str, rows: str, failed: str, relation: str, passed: str | None = None) -> str:
    return (
        f"SELECT '{check}' AS check_type, '{table}' AS table_name, '{column}' AS column_name, "
        f"{passed or f'({failed}) = 0'} AS check_passed, CAST({rows} AS BIGINT) AS records_checked, "
        f"CAST({failed} AS BIGINT) AS records_failed, ({failed}) * 100.0::DOUBLE / ({rows}) AS failure_percentage FROM {relation}"
    )


def _unique(table: str, relation: str, column: str) -> str:
    counts = f"(SELECT {column} AS v, count(*) AS n FROM {relation} GROUP BY 1)"
    shared = "coalesce(sum(n) FILTER (WHERE v IS NOT NULL AND n > 1), 0)::BIGINT"
    return _result("unique", table, column, "sum(n)::BIGINT", shared, counts)


def _not_null(table: str, relation: str, columns: tuple[str, ...]) -> list[str]:
    return [_result("not_null", table, c, "count(*)", f"count(*) - count({c})", relation) for c in columns]


def _row(check: str, table: str, relation: str, column: str, bad: str) -> str:
    return _result(check, table, column, "count(*)", f"count(*) FILTER (WHERE {bad})", relation)


BODIES["tests_unique"] = " UNION ALL ".join(
    [
        _unique("online_retail_raw", "bronze", "bronze_id"),
        _unique("ingestion_log", "log_now", "batch_id"),
        _unique("stg_bronze__online_retail", "silver", "bronze_id"),
        _unique("dim_customer", "dim_customer", "customer_key"),
        _unique("dim_customer", "dim_customer", "customer_id"),
    ]
)
BODIES["repeated_hash_keys"] = (
    "SELECT record_hash, count(*) AS n_records FROM silver GROUP BY record_hash HAVING count(*) > 1"
)
_SILVER_NOT_NULL = (
    "bronze_id", "invoice_number", "stock_code", "quantity", "unit_price", "invoice_timestamp", "invoice_date",
    "country", "line_total",
)
# The raw lines have no file name column here; the staged ones always have one.
_FILE_NAME = _result("not_null", "online_retail_raw", "source_file_name", "count(*)", "0", "bronze")
BODIES["tests_not_null"] = " UNION ALL ".join(
    _not_null(
        "online_retail_raw", "bronze",
        ("bronze_id", "invoice", "stock_code", "invoice_date", "country", "load_timestamp", "load_batch_id"),
    )
    + [_FILE_NAME]
    + _not_null("stg_bronze__online_retail", "typed", _SILVER_NOT_NULL)
    + _not_null("dim_customer", "dim_customer", ("customer_key", "customer_id", "total_lifetime_value"))
)
_LOG_EVENTS = "(SELECT 'RUNNING' AS status FROM log_now UNION ALL SELECT status FROM log_now)"
BODIES["tests_accepted"] = " UNION ALL ".join(
    [
        _row("accepted_range", "stg_bronze__online_retail", "typed", "quantity", "quantity NOT BETWEEN -10000 AND 10000"),
        _row("accepted_range", "stg_bronze__online_retail", "typed", "unit_price", "unit_price NOT BETWEEN 0 AND 50000"),
        _row("accepted_range", "dim_customer", "dim_customer", "total_lifetime_value", "total_lifetime_value < 0"),
        _row("accepted_values", "dim_customer", "dim_customer", "frequency_segment",
             "frequency_segment NOT IN ('Frequent', 'Regular', 'Occasional', 'One-time')"),
        _row("accepted_values", "dim_customer", "dim_customer", "value_segment",
             "value_segment NOT IN ('VIP', 'High-Value', 'Medium-Value', 'Low-Value')"),
        _row("accepted_values", "dim_customer", "dim_customer", "recency_segment",
             "recency_segment NOT IN ('Active', 'Lapsing', 'Dormant', 'Churned')"),
        _row("accepted_values", "ingestion_log", _LOG_EVENTS, "status",
             "status NOT IN ('STARTED', 'SUCCESS', 'FAILED', 'RUNNING')"),
    ]
)
BODIES["failing_quantities"] = "SELECT bronze_id, quantity FROM typed WHERE quantity NOT BETWEEN -10000 AND 10000"
BODIES["expression_tests"] = " UNION ALL ".join(
    [
        _row("expression_is_true", "fact_sales", "fact", "net_amount", "net_amount <> line_total - discount_amount"),
        _row("expression_is_true", "fact_sales", "fact", "quantity", "NOT quantity > 0"),
        _result("at_least_one", "stg_bronze__online_retail", "customer_id", "count(*)",
                "CASE WHEN count(customer_id) > 0 THEN 0 ELSE count(*) END", "silver", "count(customer_id) > 0"),
        _result("relationships", "fact_sales", "customer_key", "count(customer_key)",
                "count(customer_key) FILTER (WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer WHERE total_orders > 1))",
                "fact"),
    ]
)


def _fresh(table: str, newest: str, relation: str, warn: int, error: int) -> str:
    age = f"date_diff('second', max({newest}), TIMESTAMP '2001-08-10')"
    return (
        f"SELECT '{table}' AS table_name, max({newest}) AS max_loaded_at, {age} AS age_seconds, "
        f"CASE WHEN {age} > {error} * 86400 THEN 'error' WHEN {age} > {warn} * 86400 THEN 'warn' ELSE 'pass' END AS status "
        f"FROM {relation}"
    )


BODIES["freshness"] = (
    _fresh("online_retail_raw", "load_timestamp", "bronze", 7, 14)
    + " UNION ALL "
    + _fresh("ingestion_log", "ingestion_end_time", "log_now", 30, 60)
)
BODIES["check_results"] = (
    "SELECT 'BATCH_200108' AS batch_id, check_type, table_name, column_name, check_passed, records_checked, "
    "records_failed, round(failure_percentage, 2) AS failure_percentage FROM ("
    + " UNION ALL ".join(_not_null("stg_bronze__online_retail", "typed", _SILVER_NOT_NULL))
    + ")"
)

BODIES["profile_columns"] = "SELECT * FROM column_stats"
BODIES["profile_numeric"] = " UNION ALL ".join(
    f"""SELECT s.* EXCLUDE (total_rows), (SELECT count(*) FROM profile WHERE {c} < s.q1 - 1.5 * (s.q3 - s.q1)
    OR {c} > s.q3 + 1.5 * (s.q3 - s.q1)) AS outlier_count,
  round((SELECT count(*) FROM profile WHERE {c} < s.q1 - 1.5 * (s.q3 - s.q1) OR {c} > s.q3 + 1.5 * (s.q3 - s.q1))::DOUBLE
    / total_rows * 100, 4) AS outlier_percentage FROM numeric_stats s WHERE column_name = '{c}'"""
    for c in ("quantity", "unit_price")
)
BODIES["profile_text"] = " UNION ALL ".join(
    rf"""SELECT '{c}' AS column_name, CAST(sum(length({c})) AS DOUBLE) / count({c}) AS avg_length,
  CAST(min(length({c})) AS INTEGER) AS min_length, CAST(max(length({c})) AS INTEGER) AS max_length,
  count(*) FILTER (WHERE {c} = '') AS empty_string_count,
  count(*) FILTER (WHERE regexp_matches({c}, '^\s*$')) AS whitespace_only_count,
  count(*) FILTER (WHERE regexp_matches({c}, '(^\s)|(\s$)')) AS has_leading_trailing_spaces,
  count(*) FILTER (WHERE regexp_matches({c}, '[^\w\s-]')) AS has_special_characters FROM profile"""
    for c in ("invoice", "stock_code", "description", "customer_id", "country")
)
BODIES["profile_datetime"] = """
SELECT 'invoice_date' AS column_name, min(invoice_date) AS min_date, max(invoice_date) AS max_date,
  CAST(floor(date_diff('second', min(invoice_date), max(invoice_date)) / 86400.0) AS BIGINT) AS date_range_days,
  count(DISTINCT year(invoice_date)) AS unique_years, count(DISTINCT month(invoice_date)) AS unique_months,
  count(DISTINCT day(invoice_date)) AS unique_days, count(DISTINCT hour(invoice_date)) AS unique_hours,
  count(*) FILTER (WHERE dayofweek(invoice_date) IN (0, 6)) AS weekend_transactions,
  count(*) FILTER (WHERE hour(invoice_date) BETWEEN 9 AND 17) AS business_hours_transactions FROM profile"""
BODIES["top_values"] = """
SELECT column_name, value, n, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INTEGER) AS rank
FROM profile_counts WHERE value IS NOT NULL AND column_name NOT IN ('quantity', 'unit_price', 'invoice_date')
QUALIFY rank <= 10"""
BODIES["summary_stats"] = """
SELECT c.column_name, c.non_null_count AS count, c.unique_count, t.value AS top, t.n AS freq, s.mean, s.std_dev,
  s.min_value, s.q1, s.median, s.q3, s.max_value FROM column_stats c
LEFT JOIN (SELECT column_name, value, n FROM profile_counts WHERE value IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) = 1) t ON c.column_name = t.column_name
LEFT JOIN numeric_stats s ON c.column_name = s.column_name"""
BODIES["overview"] = """
SELECT count(*) AS total_records, 10 AS total_columns, min(invoice_date) AS min_date, max(invoice_date) AS max_date,
  CAST(floor(date_diff('second', min(invoice_date), max(invoice_date)) / 86400.0) AS BIGINT) AS date_span_days,
  max(load_timestamp) AS latest_load, min(load_timestamp) AS oldest_load, count(DISTINCT invoice) AS unique_invoices,
  count(DISTINCT stock_code) AS unique_products, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT country) AS unique_countries FROM profile"""
BODIES["duplicate_rows"] = "SELECT * FROM copies"
BODIES["quality_scores"] = """
SELECT * REPLACE (round(overall_score, 8) AS overall_score, round(completeness_score, 8) AS completeness_score,
  round(validity_score, 8) AS validity_score, round(consistency_score, 8) AS consistency_score) FROM scores"""
BODIES["quality_issues"] = "SELECT * FROM issues"

_HIGH_NULLS = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN null_{c}::DOUBLE / total_records * 100 > 10 THEN '{c}' END" for c in _PROFILE_COLUMNS
) + ")"
BODIES["recommendations"] = f"""
SELECT * FROM (SELECT 'Data Quality' AS category, 'High' AS priority, 'High null rates in columns: ' || {_HIGH_NULLS} AS issue,
  'Investigate data sources and implement validation at ingestion point' AS recommendation FROM quality WHERE {_HIGH_NULLS} <> ''
UNION ALL SELECT 'Business Rules', 'Critical', 'Negative unit prices detected',
  'Implement price validation constraints and investigate source system' FROM quality WHERE negative_prices > 0
UNION ALL SELECT 'Data Validation', 'Medium', 'Zero quantity transactions found',
  'Clarify business rules for zero-quantity transactions or filter them out' FROM quality WHERE zero_quantities > 0
UNION ALL SELECT 'Customer Analytics', 'Medium',
  printf('%.1f%% of transactions lack customer IDs', null_customer_id::DOUBLE / total_records * 100),
  'Improve customer identification processes for better analytics' FROM quality
  WHERE null_customer_id::DOUBLE / total_records * 100 > 20
UNION ALL SELECT 'Performance', 'Medium', 'Large dataset detected',
  'Consider implementing data partitioning and archiving strategies' FROM quality WHERE total_records > 500000)"""
BODIES["metric_rows"] = """
SELECT (SELECT batch_id FROM log_now WHERE status = 'SUCCESS' ORDER BY ingestion_start_time DESC, batch_id DESC LIMIT 1) AS load_id,
  'bronze.online_retail_raw' AS table_name, metric_name, round(metric_value, 8) AS metric_value,
  'Data profiling metric from automated assessment' AS metric_description FROM (
  SELECT 'total_records' AS metric_name, total_records::DOUBLE AS metric_value FROM scores
  UNION ALL SELECT 'overall_quality_score', overall_score FROM scores
  UNION ALL SELECT 'completeness_score', completeness_score FROM scores
  UNION ALL SELECT 'validity_score', validity_score FROM scores
  UNION ALL SELECT 'consistency_score', consistency_score FROM scores
  UNION ALL SELECT 'critical_issues', critical_issues::DOUBLE FROM scores
  UNION ALL SELECT 'high_issues', high_issues::DOUBLE FROM scores
  UNION ALL SELECT 'medium_issues', medium_issues::DOUBLE FROM scores)"""

BODIES["revenue_analysis"] = """
SELECT CAST(CAST(sum(revenue) AS VARCHAR) AS DOUBLE) AS total_revenue, CAST(CAST(sum(revenue) AS VARCHAR) AS DOUBLE) / count(revenue) AS average_transaction_value,
  CAST(CAST(max(revenue) AS VARCHAR) AS DOUBLE) AS highest_single_transaction, count(*) FILTER (WHERE revenue < 0) AS negative_revenue_transactions,
  round(quantile_cont(CAST(revenue AS DOUBLE), 0.5), 6) AS median_transaction_value FROM profile"""
BODIES["customer_analysis"] = """
SELECT count(customer_id) AS total_customers, CAST(sum(n) FILTER (WHERE customer_id IS NOT NULL) AS BIGINT) AS transactions_with_customer_id,
  CAST(coalesce(sum(n) FILTER (WHERE customer_id IS NULL), 0) AS BIGINT) AS anonymous_transactions,
  max(n) FILTER (WHERE customer_id IS NOT NULL) AS max_transactions_by_single_customer,
  count(*) FILTER (WHERE customer_id IS NOT NULL AND n > 1) AS repeat_customers,
  CAST(sum(n) FILTER (WHERE customer_id IS NOT NULL) * 100 AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS customer_id_coverage,
  CAST(sum(n) FILTER (WHERE customer_id IS NOT NULL) AS DOUBLE) / count(customer_id) AS avg_transactions_per_customer
FROM (SELECT customer_id, count(*) AS n FROM profile GROUP BY customer_id)"""
BODIES["geo_analysis"] = """
SELECT 'total_countries' AS section, NULL AS label, count(DISTINCT country) AS n FROM profile
UNION ALL SELECT 'home_transactions', NULL, count(*) FILTER (WHERE trim(upper(country)) = 'NATION_7') FROM profile
UNION ALL SELECT 'international_transactions', NULL, count(*) FILTER (WHERE trim(upper(country)) IS DISTINCT FROM 'NATION_7') FROM profile
UNION ALL SELECT * FROM (SELECT 'top_country', trim(upper(country)) AS c, count(*) AS k FROM profile WHERE country IS NOT NULL
  GROUP BY 2 ORDER BY k DESC, c LIMIT 10)"""
BODIES["product_analysis"] = """
SELECT 'total_products' AS section, NULL AS label, count(DISTINCT stock_code) AS n FROM profile
UNION ALL SELECT 'single_transaction_products', NULL, count(*) FROM (SELECT stock_code FROM profile WHERE stock_code IS NOT NULL
  GROUP BY stock_code HAVING count(*) = 1)
UNION ALL SELECT * FROM (SELECT 'popular_product', stock_code AS c, count(*) AS k FROM profile WHERE stock_code IS NOT NULL
  GROUP BY 2 ORDER BY k DESC, c LIMIT 10)"""
BODIES["temporal_analysis"] = """
SELECT * FROM (SELECT 'peak_hour' AS section, CAST(hour(invoice_date) AS VARCHAR) AS label, count(*) AS n FROM profile
  WHERE invoice_date IS NOT NULL GROUP BY hour(invoice_date) ORDER BY n DESC, hour(invoice_date) LIMIT 5)
UNION ALL SELECT 'weekday', strftime(invoice_date, '%A'), count(*) FROM profile WHERE invoice_date IS NOT NULL GROUP BY 2
UNION ALL SELECT 'month', strftime(invoice_date, '%B'), count(*) FROM profile WHERE invoice_date IS NOT NULL GROUP BY 2
UNION ALL SELECT 'weekend_transactions', NULL, count(*) FILTER (WHERE dayofweek(invoice_date) IN (0, 6)) FROM profile
UNION ALL SELECT 'weekday_transactions', NULL, count(*) FILTER (WHERE coalesce(dayofweek(invoice_date) NOT IN (0, 6), TRUE)) FROM profile"""
BODIES["monthly_revenue"] = """
SELECT CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
  CAST(min(date_trunc('month', invoice_date)) AS DATE) AS month_start, CAST(CAST(sum(revenue) AS VARCHAR) AS DOUBLE) AS revenue
FROM profile WHERE invoice_date IS NOT NULL GROUP BY 1, 2"""
BODIES["monthly_sales"] = """
SELECT CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
  CAST(min(date_trunc('month', full_date)) AS DATE) AS month_start, CAST(sum(line_total) AS DOUBLE) AS revenue
FROM fact GROUP BY 1, 2"""
BODIES["top_countries"] = """
SELECT country, CAST(CAST(sum(revenue) AS VARCHAR) AS DOUBLE) AS revenue FROM profile WHERE country IS NOT NULL GROUP BY country
ORDER BY sum(revenue) DESC NULLS LAST, country LIMIT 10"""
BODIES["customers_per_country"] = """
SELECT country, count(DISTINCT customer_id) AS customers FROM profile WHERE customer_id IS NOT NULL GROUP BY country"""
BODIES["top_customers"] = """
SELECT customer_id, CAST(CAST(sum(revenue) AS VARCHAR) AS DOUBLE) AS revenue FROM profile WHERE customer_id IS NOT NULL GROUP BY customer_id
ORDER BY sum(revenue) DESC NULLS LAST, customer_id LIMIT 10"""
BODIES["customer_revenue_summary"] = """
SELECT count(*) AS total_customers, CAST(CAST(sum(r) AS VARCHAR) AS DOUBLE) / count(*) AS mean_revenue,
  round(quantile_cont(CAST(r AS DOUBLE), 0.5), 6) AS median_revenue
FROM (SELECT coalesce(sum(revenue), 0) AS r FROM profile WHERE customer_id IS NOT NULL GROUP BY customer_id)"""
BODIES["top_products"] = """
SELECT p.stock_code, CAST(CAST(p.revenue AS VARCHAR) AS DOUBLE) AS revenue, CAST(CAST(p.quantity AS VARCHAR) AS DOUBLE) AS quantity,
  coalesce(d.description[1:30], 'No Description') AS description
FROM (SELECT stock_code, sum(revenue) AS revenue, sum(quantity) AS quantity FROM profile WHERE stock_code IS NOT NULL
  GROUP BY stock_code ORDER BY sum(revenue) DESC NULLS LAST, stock_code LIMIT 10) p
LEFT JOIN (SELECT stock_code, description FROM profile WHERE description IS NOT NULL QUALIFY row_number() OVER (
  PARTITION BY stock_code ORDER BY invoice_date IS NULL, invoice_date, description) = 1) d ON p.stock_code = d.stock_code"""
BODIES["described_products"] = """
SELECT count(DISTINCT stock_code) AS total_products,
  count(DISTINCT CASE WHEN description IS NOT NULL THEN stock_code END) AS described_products FROM profile"""
BODIES["issue_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS issue, count(*) FILTER (WHERE {test}) AS records, "
    f"count(*) FILTER (WHERE {test})::DOUBLE / count(*) * 100 AS percentage FROM profile"
    for name, test in (
        ("negative_quantity", "quantity < 0"),
        ("zero_or_negative_price", "unit_price <= 0"),
        ("missing_customer", "customer_id IS NULL"),
        ("missing_description", "description IS NULL"),
    )
)
BODIES["exploration_summary"] = """
SELECT count(*) AS total_records, min(invoice_date) AS first_date, max(invoice_date) AS last_date,
  CAST(CAST(sum(revenue) AS VARCHAR) AS DOUBLE) AS total_revenue, CAST(CAST(sum(revenue) AS VARCHAR) AS DOUBLE) / count(revenue) AS revenue_per_line,
  CAST(bool_or(quantity < 0) AS INTEGER) + CAST(bool_or(unit_price <= 0) AS INTEGER)
    + CAST(bool_or(customer_id IS NULL) AS INTEGER) + CAST(bool_or(description IS NULL) AS INTEGER) AS data_quality_issues,
  count(*) - count(invoice) AS missing_invoice, count(*) - count(stock_code) AS missing_stock_code,
  count(*) - count(description) AS missing_description, count(*) - count(quantity_text) AS missing_quantity,
  count(*) - count(invoice_date) AS missing_invoice_date, count(*) - count(unit_price_text) AS missing_unit_price,
  count(*) - count(customer_id) AS missing_customer, count(*) - count(country) AS missing_country, 8 AS total_columns,
  (SELECT CAST(CAST(sum(v) AS VARCHAR) AS DOUBLE) / count(v) FROM (SELECT sum(revenue) AS v FROM profile GROUP BY invoice)) AS avg_order_value,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT stock_code) AS unique_products,
  count(DISTINCT country) AS countries FROM profile"""

BODIES["safe_ratio"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_discount * 100 IS NULL OR l_discount * 100 = 0 THEN -1.0::DOUBLE ELSE l_quantity / (l_discount * 100) END AS ratio
FROM lineitem"""
BODIES["cents"] = """
SELECT p_partkey, CAST(CAST(c / 100.0 AS DECIMAL(18,2)) AS DOUBLE) AS dollars,
  CAST(round(CAST(c / 100.0 AS DECIMAL(18,2)), 1) AS DOUBLE) AS dollars_1
FROM (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS c FROM part)"""
BODIES["surrogate_keys"] = """
SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS order_key,
  md5(CAST(o_custkey AS VARCHAR) || '-' || CASE WHEN o_custkey % 4 <> 0 THEN o_orderstatus
    ELSE '_dbt_utils_surrogate_key_null_' END) AS pair_key FROM orders"""


# The whole profile as (section, column_name, metric, number, text) rows.
_SECTIONS = {
    "dataset_overview": ("overview", None, (
        "total_records", "total_columns", "min_date", "max_date", "date_span_days", "latest_load", "oldest_load",
        "unique_invoices", "unique_products", "unique_customers", "unique_countries")),
    "column_profiles": ("profile_columns", "column_name", (
        "non_null_count", "null_count", "null_percentage", "unique_count", "unique_percentage")),
    "numeric_profiles": ("profile_numeric", "column_name", (
        "min_value", "max_value", "mean", "median", "std_dev", "q1", "q3", "zero_count", "negative_count",
        "positive_count", "outlier_count", "outlier_percentage", "unfit_count")),
    "text_profiles": ("profile_text", "column_name", (
        "avg_length", "min_length", "max_length", "empty_string_count", "whitespace_only_count",
        "has_leading_trailing_spaces", "has_special_characters")),
    "datetime_profiles": ("profile_datetime", "column_name", (
        "min_date", "max_date", "date_range_days", "unique_years", "unique_months", "unique_days", "unique_hours",
        "weekend_transactions", "business_hours_transactions")),
    "data_quality": ("quality_scores", None, (
        "total_records", "overall_score", "completeness_score", "validity_score", "consistency_score",
        "critical_issues", "high_issues", "medium_issues", "low_issues")),
    "revenue_analysis": ("revenue_analysis", None, (
        "total_revenue", "average_transaction_value", "highest_single_transaction", "negative_revenue_transactions",
        "median_transaction_value")),
    "customer_analysis": ("customer_analysis", None, (
        "total_customers", "transactions_with_customer_id", "anonymous_transactions",
        "max_transactions_by_single_customer", "repeat_customers", "customer_id_coverage",
        "avg_transactions_per_customer")),
}
BLOCKS |= {f"section_{name}": BODIES[body] for name, (body, _, _) in _SECTIONS.items()}
BLOCKS |= {
    "section_products": BODIES["product_analysis"],
    "section_times": BODIES["temporal_analysis"],
    "section_tops": BODIES["top_values"],
    "section_advice": BODIES["recommendations"],
    "section_countries": BODIES["geo_analysis"].replace("trim(upper(country))", "country").replace("NATION_7", "United Kingdom"),
}
_TIDY = [
    f"SELECT '{name}' AS section, {column or 'NULL'} AS column_name, '{m}' AS metric, CAST({m} AS VARCHAR) AS value "
    f"FROM section_{name}"
    for name, (_, column, metrics) in _SECTIONS.items()
    for m in metrics
] + [
    f"SELECT '{name}', section, label, CAST(n AS VARCHAR) FROM {block}"
    for name, block in (
        ("geographic_analysis", "section_countries"),
        ("product_analysis", "section_products"),
        ("temporal_analysis", "section_times"),
    )
] + [
    "SELECT 'top_values', column_name, value, CAST(n AS VARCHAR) FROM section_tops",
    "SELECT 'quality_issues', column_name, severity || '/' || type, description FROM issues",
    "SELECT 'recommendations', category, priority, issue || ': ' || recommendation FROM section_advice",
]
BODIES["profile_report"] = (
    "SELECT section, column_name, metric, round(TRY_CAST(value AS DOUBLE), 4) AS number, "
    "CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text FROM (" + " UNION ALL ".join(_TIDY) + ")"
)


def _needed(text: str) -> list[str]:
    """Names of the blocks a text uses, directly or through other blocks."""
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", re.sub(r"'[^']*'", "", todo.pop())))
        for name in words & (set(BLOCKS) - found):
            found.add(name)
            todo.append(BLOCKS[name])
    return [name for name in BLOCKS if name in found]


def all_oracles() -> dict[str, str]:
    statements = {}
    for name, body in BODIES.items():
        blocks = ", ".join(f"{b} AS MATERIALIZED ({BLOCKS[b].strip()})" for b in _needed(body))
        statements[name] = f"WITH {blocks} {body.strip()}" if blocks else body.strip()
    return statements
