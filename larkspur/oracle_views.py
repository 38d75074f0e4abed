"""The domain views of ``larkspur.domain`` once more, as SQL for the checks."""

VIEWS: dict[str, str] = {
    "v_customers": """
SELECT c_custkey AS customer_id, c_name AS customer_name,
  'customer' || c_custkey || CASE WHEN c_custkey % 97 = 0 THEN '' ELSE '@email.com' END AS email,
  '+1-555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
  n_name AS country, 'CITY_' || (c_custkey % 15) AS city,
  DATE '1995-01-01' + CAST(c_custkey % 730 AS INTEGER) AS signup_date, c_mktsegment AS customer_segment
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_products": """
SELECT p_partkey AS product_id, p_name || ' Model-' || p_partkey AS product_name, p_type AS category,
  'SIZE_' || (p_size // 10) AS subcategory, p_brand AS brand,
  CAST(p_retailprice AS DECIMAL(8,2)) AS unit_price,
  CAST(CAST(p_retailprice AS DECIMAL(8,2)) * (p_size + 40) * 0.01 AS DECIMAL(12,4)) AS cost_price,
  p_size * 10 AS stock_quantity
FROM part""",
    "v_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PROCESSING' WHEN 'P' THEN 'PENDING' ELSE o_orderstatus END AS order_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'PayPal' WHEN '3-MEDIUM' THEN 'Debit Card'
    WHEN '4-NOT SPECIFIED' THEN 'Bank Transfer' WHEN '5-LOW' THEN 'Cash on Delivery' ELSE o_orderpriority END AS payment_method,
  CAST(o_orderkey % 46 + 5 AS DECIMAL(8,2)) AS shipping_cost, CAST(o_orderkey % 101 AS DECIMAL(8,2)) AS discount_amount
FROM orders""",
    "v_items": """
SELECT *, CAST(quantity * unit_price AS DECIMAL(18,4)) AS subtotal,
  CAST(quantity * unit_price * discount_percent * 0.01 AS DECIMAL(18,4)) AS line_discount,
  CAST(quantity * unit_price * (100 - discount_percent) * 0.01 AS DECIMAL(18,4)) AS net_amount
FROM (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS order_item_id,
  l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
  CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) * 0.01 AS DECIMAL(10,2)) AS unit_price,
  CAST(round(l_discount * 100) AS INTEGER) AS discount_percent FROM lineitem)""",
    "v_movements": """
SELECT l_partkey AS product_id, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'PURCHASE'
    WHEN l_returnflag = 'N' THEN 'SALE' WHEN l_returnflag = 'R' THEN 'RETURN' ELSE 'ADJUSTMENT' END AS movement_type,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_shipdate AS DATE) AS movement_date, l_orderkey AS reference_id
FROM lineitem""",
    "v_header": """
SELECT o_orderkey AS order_id, o_custkey % (SELECT count(*) FROM supplier) AS truck_id,
  CAST(o_orderkey % 25 AS DOUBLE) AS location_id, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS customer_id,
  o_orderdate + to_seconds(o_orderkey % 86400) AS order_ts, CAST(o_totalprice AS DECIMAL(18,4)) AS order_amount,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 40 AS VARCHAR) END AS order_tax_amount,
  CAST(o_orderkey % 101 AS VARCHAR) AS order_discount_amount, CAST(o_totalprice AS DECIMAL(18,4)) AS order_total
FROM orders""",
    "v_landing": """
SELECT o_orderkey + shift AS order_id, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS customer_id,
  o_orderdate + to_seconds(o_orderkey % 86400) AS order_ts,
  CASE WHEN o_orderkey % 991 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,4)) END AS order_amount,
  CAST(CASE WHEN o_orderkey % 997 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,4)) AS order_total
FROM (SELECT *, 0 AS shift FROM orders UNION ALL
  SELECT *, 1000000000 AS shift FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')""",
    "v_detail": """
SELECT order_item_id AS order_detail_id, order_id, line_number, product_id AS menu_item_id, quantity, unit_price, subtotal AS price
FROM v_items""",
    "v_truck": """
SELECT s_suppkey AS truck_id, s_suppkey % 6 AS menu_type_id, 'CITY_' || s_nationkey AS primary_city, r_name AS region,
  n_name AS country, CASE WHEN s_suppkey % 20 < 10 THEN 1 ELSE 0 END AS franchise_flag, s_suppkey % 20 AS franchise_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_franchise": """
SELECT s_suppkey % 20 AS franchise_id, min(s_name) AS first_name, max(s_name) AS last_name FROM supplier GROUP BY 1""",
    "v_location": """
SELECT CAST(n_nationkey AS BIGINT) AS location_id, 'CITY_' || n_nationkey AS city, r_name AS region,
  'N' || n_nationkey AS iso_country_code, n_name AS country FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_menu": """
SELECT p_partkey AS menu_item_id, CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'PROMO' THEN 3
    WHEN 'SMALL' THEN 4 WHEN 'STANDARD' THEN 5 END AS menu_type_id, p_type AS menu_type,
  'Truck ' || upper(p_type[1]) || lower(p_type[2:]) AS truck_brand_name, p_name AS menu_item_name,
  CAST(CAST(p_retailprice AS DECIMAL(8,2)) * 0.04 * p_size AS DECIMAL(18,4)) AS cost_of_goods_usd,
  CAST(p_retailprice AS DECIMAL(18,4)) AS sale_price_usd, p_size
FROM part""",
    "v_loyalty": """
SELECT customer_id, customer_name AS first_name, 'Family' || (customer_id % 500) AS last_name, city, country,
  CASE WHEN customer_id % 89 = 0 THEN NULL WHEN customer_id % 83 = 0 THEN '' ELSE email END AS e_mail, phone AS phone_number,
  CAST(customer_id % 4 AS VARCHAR) AS children_count, CASE WHEN customer_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN customer_id % 3 = 0 THEN 'Single' ELSE 'Married' END AS marital_status, signup_date AS sign_up_date
FROM v_customers""",
    "v_weather": """
SELECT DATE '1997-02-01' + CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS date_valid_std,
  CAST(user_id % 50 AS VARCHAR) AS postal_code, 'NATION_' || (user_id % 25) AS country,
  CAST(max(CAST(value AS DECIMAL(10,2))) + 20.00 AS DECIMAL(12,2)) AS avg_temperature_f,
  CAST(sum(CAST(value AS DECIMAL(10,2))) * 0.01 AS DECIMAL(18,4)) AS tot_precipitation_in,
  max(CAST(value AS DECIMAL(10,2))) AS max_wind_mph
FROM events GROUP BY 1, 2, 3""",
    "v_postal": """
SELECT DISTINCT CAST(user_id % 50 AS VARCHAR) AS postal_code, 'NATION_' || (user_id % 25) AS country,
  'CITY_' || (user_id % 25) AS city_name FROM events""",
    "v_changes": """
SELECT user_id AS key, ts AS commit_ts, event_id AS commit_id, step, action, is_update,
  CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS payload, event_type AS origin
FROM (SELECT *, 0 AS step, 'DELETE' AS action, event_type = 'click' AS is_update FROM events WHERE event_type IN ('click', 'error')
  UNION ALL SELECT *, 1, 'INSERT', event_type = 'click' FROM events WHERE event_type <> 'error')""",
    "v_stage_events": """
SELECT event_id, ts AS event_timestamp, CASE WHEN event_type IN ('view', 'purchase') THEN 'SPAN' ELSE 'LOG' END AS record_type,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' ELSE 'INFO' END AS severity_level,
  'proc_' || (user_id % 5) AS procedure_name, user_id || '-' || strftime(ts, '%Y%m%d') AS trace_id,
  'step_' || (user_id % 5) AS process_step, event_type || ' event' AS message, props AS attributes,
  event_type = 'error' AS error_flag,
  CASE WHEN event_type = 'error' THEN 'failed with code ' || (CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) % 10) END AS error_message,
  CAST(floor(value * 10) AS BIGINT) AS execution_time_ms, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS records_processed
FROM events""",
    "v_alerts": """
SELECT event_id AS alert_id, ts AS alert_time, 'ALERT_' || upper(event_type) AS alert_name,
  CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'click' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END AS severity,
  'CATEGORY_' || (user_id % 3) AS category, 'found ' || regexp_extract(props, '(\\d+)', 1) AS message,
  CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS record_count, 'table_' || (user_id % 7) AS affected_table,
  value < 25 AS resolved_flag
FROM events""",
    "v_wages": """
SELECT o_orderpriority AS variable, CASE WHEN o_orderstatus = 'P' THEN 'country/CAN' ELSE 'country/USA' END AS geo_id,
  CAST(o_orderdate AS DATE) AS date, CAST(o_totalprice AS DECIMAL(18,4)) AS value FROM orders""",
    "v_wage_attributes": """
SELECT DISTINCT o_orderpriority AS variable, o_orderpriority || CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
  THEN ' Annual Wages' ELSE ' hours worked' END AS variable_name FROM orders""",
    "v_prices": """
SELECT p_type AS variable, CASE WHEN l_returnflag = 'R' THEN 'country/CAN' ELSE 'country/USA' END AS geo_id,
  CAST(l_shipdate AS DATE) AS date, CAST(l_extendedprice AS DECIMAL(18,4)) AS value
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_price_attributes": """
SELECT DISTINCT p_type AS variable, p_type || CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN ' CPI index' ELSE ' list price' END
  AS variable_name FROM part""",
}
