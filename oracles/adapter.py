"""The two inputs as SQL over the test tables, the text of FIXTURES.md."""

FINANCE_SQL = """
WITH b AS (
  SELECT c_custkey AS k, c_nationkey AS nk, c_mktsegment AS seg,
         (CAST(ROUND(c_acctbal * 100) AS BIGINT) + 100000) * 12 AS inc
  FROM {customer})
SELECT CAST(k AS BIGINT) AS id,
  CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(inc / CAST(100 AS DOUBLE) AS DECIMAL(12,2)) END AS income,
  CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(16 + k % 49 AS INT) END AS age,
  CAST(k % 5 AS INT) AS dependents,
  CASE seg WHEN 'BUILDING' THEN ' Self_Employed ' WHEN 'AUTOMOBILE' THEN 'Professional'
           WHEN 'MACHINERY' THEN 'RETIRED' WHEN 'HOUSEHOLD' THEN 'student' END AS occupation,
  CASE WHEN nk = 24 THEN NULL ELSE CONCAT('Tier_', CAST(1 + nk % 3 AS STRING)) END AS city_tier,
  CAST((CASE WHEN k % 53 = 0 THEN -1 ELSE 1 END) * (1000 + k * 37 % 20000) AS DECIMAL(12,2)) AS rent,
  CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE 500 + k * 41 % 6000 END AS DECIMAL(12,2)) AS loan_repayment,
  CAST(200 + k * 43 % 2000 AS DECIMAL(12,2)) AS insurance,
  CAST(800 + k * 47 % 7000 AS DECIMAL(12,2)) AS groceries,
  CAST(300 + k * 53 % 3000 AS DECIMAL(12,2)) AS transport,
  CAST(100 + k * 59 % 2000 AS DECIMAL(12,2)) AS eating_out,
  CAST(100 + k * 61 % 1800 AS DECIMAL(12,2)) AS entertainment,
  CAST(400 + k * 67 % 3000 AS DECIMAL(12,2)) AS utilities,
  CAST(100 + k * 71 % 1600 AS DECIMAL(12,2)) AS healthcare,
  CAST(CASE WHEN k % 4 = 0 THEN 0 ELSE k * 73 % 2500 END AS DECIMAL(12,2)) AS education,
  CAST(k * 79 % 900 AS DECIMAL(12,2)) AS miscellaneous,
  CAST(5 + k % 20 AS DECIMAL(5,2)) AS desired_savings_percentage,
  CAST(CASE WHEN k % 31 = 0 THEN 0 ELSE 500 + k * 83 % 9000 END AS DECIMAL(12,2)) AS desired_savings,
  CAST(inc / CAST(400 AS DOUBLE) - 3000 AS DECIMAL(12,2)) AS disposable_income,
  CAST(k * 7 % 1700 AS DECIMAL(12,2)) AS potential_savings_groceries,
  CAST(k * 11 % 400 AS DECIMAL(12,2)) AS potential_savings_transport,
  CAST(k * 13 % 500 AS DECIMAL(12,2)) AS potential_savings_eating_out,
  CAST(k * 17 % 300 AS DECIMAL(12,2)) AS potential_savings_entertainment,
  CAST(k * 19 % 700 AS DECIMAL(12,2)) AS potential_savings_utilities,
  CAST(k * 23 % 100 AS DECIMAL(12,2)) AS potential_savings_healthcare,
  CAST(k * 29 % 60 AS DECIMAL(12,2)) AS potential_savings_education,
  CAST(k * 31 % 100 AS DECIMAL(12,2)) AS potential_savings_miscellaneous
FROM b
"""

PAYMENTS_SQL = """
SELECT CONCAT('TXN', LPAD(CAST(o_orderkey AS STRING), CAST(greatest(9, length(CAST(o_orderkey AS STRING))) AS INT), '0')) AS transaction_id,
  CASE WHEN o_orderkey % 307 = 0 THEN NULL
       ELSE CONCAT(SUBSTRING(CAST(o_orderdate AS STRING), 1, 10), ' ', LPAD(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':15:00') END AS timestamp,
  CASE o_orderkey % 4 WHEN 0 THEN 'P2P' WHEN 1 THEN ' P2M' WHEN 2 THEN 'Bill Payment' ELSE 'Recharge' END AS transaction_type,
  CASE o_orderkey % 13 WHEN 0 THEN 'Food' WHEN 1 THEN 'Grocery' WHEN 2 THEN 'Eating_Out' WHEN 3 THEN 'Entertainment'
    WHEN 4 THEN 'Shopping ' WHEN 5 THEN 'Fuel' WHEN 6 THEN 'Transport' WHEN 7 THEN 'Healthcare' WHEN 8 THEN 'Insurance'
    WHEN 9 THEN 'Education' WHEN 10 THEN 'Utilities' WHEN 11 THEN 'Recharge' END AS merchant_category,
  CASE WHEN o_orderkey % 173 = 0 THEN NULL WHEN o_orderkey % 179 = 0 THEN CAST(-50 AS DECIMAL(12,2))
       WHEN o_orderkey % 101 = 0 THEN CAST(o_totalprice AS DECIMAL(12,2))
       ELSE CAST((CAST(ROUND(o_totalprice * 100) AS BIGINT) % (CASE WHEN o_orderkey % 2 = 0 THEN 60000 ELSE 1200000 END)) / CAST(100 AS DOUBLE) AS DECIMAL(12,2)) END AS amount_inr,
  CASE WHEN o_orderkey % 211 = 0 THEN 'PENDING' WHEN o_orderstatus = 'P' THEN ' failed' ELSE 'Success' END AS transaction_status,
  CASE o_custkey % 6 WHEN 0 THEN '18-25' WHEN 1 THEN '26 - 35' WHEN 2 THEN '36-45 ' WHEN 3 THEN '46-55' WHEN 4 THEN '56+' END AS sender_age_group,
  CASE o_orderkey % 5 WHEN 0 THEN '18-25' WHEN 1 THEN '26-35' WHEN 2 THEN '36-45' WHEN 3 THEN '46-55' ELSE '56+' END AS receiver_age_group,
  CONCAT('State ', CAST(o_custkey % 25 AS STRING)) AS sender_state,
  CONCAT('Bank ', CAST(o_custkey % 7 AS STRING)) AS sender_bank,
  CONCAT('Bank ', CAST(o_orderkey % 7 AS STRING)) AS receiver_bank,
  CASE o_orderkey % 10 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Web' WHEN 2 THEN NULL ELSE 'Android' END AS device_type,
  CASE o_orderkey % 9 WHEN 0 THEN '5G' WHEN 1 THEN 'WiFi' WHEN 2 THEN '3G' ELSE '4G' END AS network_type,
  CAST(CASE WHEN o_orderkey % 200 = 0 THEN 1 ELSE 0 END AS INT) AS fraud_flag,
  CAST(o_orderkey % 24 AS INT) AS hour_of_day,
  CASE o_orderkey % 7 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END AS day_of_week,
  CAST(CASE WHEN o_orderkey % 7 >= 5 THEN 1 ELSE 0 END AS INT) AS is_weekend
FROM {orders}
"""

# the repeated rows, as a predicate on the finished row
FINANCE_REPEATED = "id % 50 = 0"
PAYMENTS_REPEATED = "CAST(SUBSTRING(transaction_id, 4, 9) AS INT) % 50 = 0"
