"""One DuckDB statement per query. Joined tables are made as real pairs here."""

from .ctes import key_part, ETL_PAYMENT, ETL_PERSON, EXPENSES, FINANCE, NUMERIC, OUTLIERS, POTENTIALS, build, group_category, quantile, rnd

PERSON_ELT = (
    "age dependents income total_expenses expense_ratio rent groceries transport eating_out entertainment utilities "
    "healthcare education miscellaneous desired_savings disposable_income savings_achievement_rate "
    "total_potential_savings financial_health_score discretionary_spending essential_spending"
).split()
PAYMENT_ELT = (
    "transaction_id transaction_timestamp transaction_year transaction_month transaction_type merchant_category "
    "merchant_category_group spending_type transaction_amount transaction_status fraud_flag fraud_score is_high_value "
    "hour_of_day time_of_day_category is_weekend day_of_week sender_age_group sender_age_category sender_state "
    "device_type network_type sender_bank receiver_bank"
).split()
RAW_PAYMENT = (
    "transaction_id timestamp transaction_type merchant_category amount_inr transaction_status sender_age_group "
    "receiver_age_group sender_state sender_bank receiver_bank device_type network_type fraud_flag hour_of_day "
    "day_of_week is_weekend"
).split()
PAYMENT_DEFAULTS = {
    "transaction_type": "unknown", "merchant_category": "other", "transaction_status": "unknown",
    "sender_age_group": "unknown", "receiver_age_group": "unknown", "sender_state": "unknown",
    "device_type": "unknown", "network_type": "unknown",
}


def lst(parts) -> str:
    return ", ".join(parts)


def avg(c: str, name: str | None = None, digits: int = 4) -> str:
    return f"{rnd(f'avg({c})', digits)} AS {name or 'avg_' + c}"


def total(c: str, name: str, digits: int = 2) -> str:
    """Sum of money, exact."""
    return f"{rnd(f'sum(CAST({c} AS DECIMAL(18,2)))', digits)} AS {name}"


def pct(condition: str, name: str, digits: int = 2) -> str:
    return f"{rnd(f'count(*) FILTER (WHERE {condition}) * 100.0::DOUBLE / count(*)', digits)} AS {name}"


def part(condition: str, name: str, money: str = "transaction_amount") -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN {money} ELSE 0 END) AS DOUBLE) AS {name}"


def group_part(group: str, name: str) -> str:
    return part(f"merchant_category_group = '{group}'", name)


def n(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


def text(c: str) -> str:
    return f"CAST({c} AS VARCHAR) AS {c}"


def dbl(c: str, digits: int = 6) -> str:
    return f"{rnd(c, digits)} AS {c}"



ELT_FEATURE_DOUBLES = "income_normalized disposable_income_normalized expense_ratio savings_achievement_rate financial_health_score".split()
ELT_FEATURE_MONEY = "total_expenses total_potential_savings discretionary_spending essential_spending".split()
FINANCE_FEATURES = (
    "age_category age_range occupation_code occupation_category city_tier_code income_normalized "
    "disposable_income_normalized total_expenses total_potential_savings income_bracket expense_ratio "
    "savings_achievement_rate discretionary_spending essential_spending financial_health_score"
).split()
PAYMENT_FEATURES = (
    "sender_age_category receiver_age_category transaction_year transaction_month transaction_day time_of_day_category "
    "is_weekend_flag is_business_hours merchant_category_group spending_type transaction_type_category amount_normalized "
    "transaction_status_code device_type_code network_type_code transaction_amount_category fraud_score is_high_value "
    "is_unusual_time"
).split()
PAYMENT_BASE = (
    "transaction_id transaction_timestamp transaction_type merchant_category amount_inr transaction_status sender_age_group "
    "receiver_age_group sender_state sender_bank receiver_bank device_type network_type fraud_flag hour_of_day day_of_week "
    "is_weekend"
).split()
PREPARED = (
    "transaction_id timestamp transaction_type merchant_category amount transaction_status sender_age_group receiver_age_group "
    "sender_state sender_bank receiver_bank device_type network_type fraud_flag hour_of_day day_of_week is_weekend "
    "sender_age_category transaction_date transaction_year transaction_month transaction_day amount_category "
    "is_weekend_bool time_of_day"
).split()
FLAGS = [f"{c}_outlier_flag" for c in OUTLIERS]


def pick(names, doubles=(), times=(), digits: int = 6) -> str:
    """Columns as ``portable`` gives them."""
    return lst(
        dbl(f'"{c}"', digits).replace(f'AS "{c}"', f'AS "{c}"') if c in doubles
        else f'CAST("{c}" AS VARCHAR) AS "{c}"' if c in times else f'"{c}"'
        for c in names
    )


SCORE = "(avg(total_potential_savings) / avg(total_expenses) * 0.4::DOUBLE + avg(discretionary_spending) / avg(total_expenses) * 0.3::DOUBLE + (100 - avg(savings_achievement_rate)) / 100 * 0.3::DOUBLE)"
FOUR = "potential_savings_groceries + potential_savings_transport + potential_savings_eating_out + potential_savings_entertainment"


def _sources() -> dict[str, str]:
    keep = ("fraud_flag", "hour_of_day", "is_weekend")
    trimmed = [c for c in RAW_PAYMENT if c not in keep and c != "amount_inr"]
    csv_text = lst(f"coalesce(trim(\"{c}\"), '') AS \"{c}\"" for c in trimmed)
    csv_whole = lst(f"coalesce({c}, 0) AS {c}" for c in keep)
    return {
        "src_parquet": "SELECT o_orderkey, o_custkey, " + dbl("o_totalprice", 4) + " FROM orders WHERE o_orderstatus = 'P'",
        "src_json_parse": "SELECT CAST(props->>'$.k' AS INT) AS k, event_id, event_type FROM events",
        "src_csv_normalise": build(
            f"SELECT *, row_number() OVER (ORDER BY transaction_id) AS _record_number FROM ("
            f"SELECT {csv_text}, {csv_whole}, CAST(coalesce(amount_inr, 0) AS DOUBLE) AS amount_inr, "
            f"'csv_file' AS _source FROM payments_raw)", "payments_raw"),
        "src_jdbc_to_json": build(
            "SELECT CAST(id AS VARCHAR) AS key, " + lst(f"CAST({c} AS DOUBLE) AS {c}" if c in NUMERIC else c for c in FINANCE)
            + ", 'postgres' AS _source FROM finance_raw", "finance_raw"),
        "src_mapping_view": build(
            "SELECT g AS age_range, " + group_category("g", False) + " AS age_category, count(*) AS payments "
            "FROM (SELECT replace(sender_age_group, ' ', '') AS g FROM payments_raw) WHERE g IS NOT NULL GROUP BY ALL", "payments_raw"),
        "snk_partitioned_raw": build(
            "SELECT CAST(substr(\"timestamp\", 1, 4) AS INT) AS year, CAST(substr(\"timestamp\", 6, 2) AS INT) AS month, "
            "upper(trim(transaction_status)) AS status, count(*) AS records, CAST(sum(amount_inr) AS DOUBLE) AS total_amount "
            "FROM payments_raw GROUP BY ALL", "payments_raw"),
        "snk_audit_log": build(
            "SELECT 'finance' AS table_name, 'INITIAL_LOAD' AS operation, count(*) AS record_count, 'SUCCESS' AS status, "
            "CAST(NULL AS VARCHAR) AS error_message, count(*) AS total_records, min(age) AS min_age, max(age) AS max_age, "
            + avg("income") + " FROM finance_raw", "finance_raw"),
        "union_all_mapping": build(
            "SELECT g AS age_range, count(*) AS n, " + group_category("g", False) + " AS age_category FROM ("
            "SELECT replace(sender_age_group, ' ', '') AS g FROM payments_raw UNION ALL "
            "SELECT replace(receiver_age_group, ' ', '') FROM payments_raw) WHERE g IS NOT NULL GROUP BY g", "payments_raw"),
    }


def _cleaning() -> dict[str, str]:
    low = lambda c: f"lower(trim({c})) AS {c}"
    texts = ("merchant_category", "transaction_type", "transaction_status")
    return {
        "cast_numeric_safe": build(
            "SELECT transaction_id, TRY_CAST(CASE WHEN fraud_flag = 1 THEN 'n/a' ELSE CAST(amount_inr AS VARCHAR) END AS DOUBLE) AS amount, "
            "TRY_CAST(CASE WHEN hour_of_day = 3 THEN '' ELSE CAST(hour_of_day AS VARCHAR) END AS INT) AS hour FROM payments_raw", "payments_raw"),
        "parse_timestamp": build(
            "SELECT transaction_id, CAST(TRY_CAST(coalesce(CASE WHEN hour_of_day = 5 THEN substr(\"timestamp\", 1, 5) || '13-01 00:00:00' END, "
            "\"timestamp\") AS TIMESTAMP) AS VARCHAR) AS parsed FROM payments_raw", "payments_raw"),
        "standardize_text": build(
            f"SELECT transaction_id, {lst(map(low, texts))}, upper(trim(transaction_status)) AS status_upper FROM payments_raw", "payments_raw"),
        "strip_inner_spaces": build(
            "SELECT transaction_id, replace(sender_age_group, ' ', '') AS sender_age_group, "
            "replace(receiver_age_group, ' ', '') AS receiver_age_group FROM payments_raw", "payments_raw"),
        "clamp_non_negative": build(
            f"SELECT id, {lst(f'CAST(greatest(coalesce({c}, 0), 0) AS DOUBLE) AS {c}' for c in EXPENSES)} FROM finance_raw", "finance_raw"),
        "fill_constant": build(
            f"SELECT transaction_id, {lst(f'''coalesce({c}, '{d}') AS {c}''' for c, d in PAYMENT_DEFAULTS.items())} FROM payments_raw", "payments_raw"),
        "impute_median": build(f"SELECT id, {lst(dbl(c, 4) for c in NUMERIC)} FROM finance_filled", "finance_filled"),
        "dedup_by_key": build(
            f"SELECT {pick(RAW_PAYMENT, ['amount_inr'])} FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY amount_inr NULLS FIRST) AS rn FROM payments_raw) WHERE rn = 1", "payments_raw"),
        "dedup_removed": build(
            "SELECT count(*) AS input_rows, count(DISTINCT transaction_id) AS kept_rows, count(*) - count(DISTINCT transaction_id) AS removed_rows FROM payments_raw", "payments_raw"),
        "sample_limit": build(f"SELECT * FROM (SELECT DISTINCT {pick(FINANCE, NUMERIC, digits=4)} FROM finance_raw) ORDER BY id LIMIT 5", "finance_raw"),
        "dedup_full_row": build(f"SELECT DISTINCT {pick(FINANCE, NUMERIC, digits=4)} FROM finance_raw", "finance_raw"),
        "finance_clean_elt": build(
            f"SELECT person_id, {pick(['income', 'age', 'dependents', 'occupation', 'city_tier', *NUMERIC[1:], *FINANCE_FEATURES], [*NUMERIC, *ELT_FEATURE_DOUBLES, *ELT_FEATURE_MONEY])} FROM finance_elt", "finance_elt"),
        "finance_features_elt": build(
            f"SELECT person_id, {pick(FINANCE_FEATURES, [*ELT_FEATURE_DOUBLES, *ELT_FEATURE_MONEY])} FROM finance_elt", "finance_elt"),
        "upi_clean_elt": build(
            f"SELECT {pick([*PAYMENT_BASE, *PAYMENT_FEATURES], ['amount_inr', 'amount_normalized', 'fraud_score'], ['transaction_timestamp'])} FROM payments_elt", "payments_elt"),
        "upi_features_elt": build(
            f"SELECT transaction_id, {pick(PAYMENT_FEATURES, ['amount_normalized', 'fraud_score'])} FROM payments_elt", "payments_elt"),
        "finance_clean_etl": build(
            f"SELECT {pick(['id', 'age', 'dependents', 'occupation', 'city_tier', *NUMERIC, 'age_category', 'occupation_encoded', 'city_tier_encoded', *FLAGS, 'income_normalized', 'disposable_income_normalized'], [*NUMERIC, 'income_normalized', 'disposable_income_normalized'])} FROM finance_etl", "finance_etl"),
        "finance_features_etl": build(
            f"SELECT {pick(['id', 'age_category', 'occupation_encoded', 'city_tier_encoded', *FLAGS, 'income_normalized', 'disposable_income_normalized'], ['income_normalized', 'disposable_income_normalized'])} FROM finance_etl", "finance_etl"),
        "upi_clean_etl": build(
            f"SELECT {pick([*PREPARED, 'amount_normalized'], ['amount', 'amount_normalized'], ['timestamp', 'transaction_date'])} FROM payments_etl", "payments_etl"),
        "upi_features_etl": build(
            f"SELECT {pick(['transaction_id', *PREPARED[17:]], [], ['transaction_date'])} FROM payments_prepared", "payments_prepared"),
        "rejected_rows": build(
            f"SELECT {pick(PREPARED, ['amount'], ['timestamp', 'transaction_date'])} FROM payments_prepared WHERE NOT coalesce(amount > 0 AND \"timestamp\" IS NOT NULL AND transaction_id IS NOT NULL, false)", "payments_prepared"),
        "except_rejected": build(
            f"SELECT {pick(PREPARED, ['amount'], ['timestamp', 'transaction_date'])} FROM (SELECT {lst(f'"{c}"' for c in PREPARED)} FROM payments_prepared EXCEPT SELECT {lst(f'"{c}"' for c in PREPARED)} FROM payments_etl)", "payments_prepared", "payments_etl"),
        "filter_required_keys": build(
            "SELECT transaction_id, \"timestamp\" FROM payments_raw WHERE transaction_id IS NOT NULL AND \"timestamp\" IS NOT NULL", "payments_raw"),
        "filter_finance_valid": build("SELECT age, count(*) AS people, CAST(min(income) AS DOUBLE) AS min_income FROM finance_elt GROUP BY age", "finance_elt"),
        "filter_upi_valid_elt": build("SELECT transaction_status, count(*) AS payments, CAST(max(amount_inr) AS DOUBLE) AS max_amount FROM payments_elt GROUP BY 1", "payments_elt"),
        "filter_upi_valid_etl": build("SELECT transaction_id, " + dbl("amount", 4) + " FROM payments_etl", "payments_etl"),
        "filter_success": build("SELECT transaction_id, CAST(amount_inr AS DOUBLE) AS amount_inr FROM payments_elt WHERE transaction_status = 'SUCCESS'", "payments_elt"),
        "anti_join_orphans": build(
            "SELECT DISTINCT r AS value FROM (SELECT trim(lower(receiver_age_group)) AS r FROM payments_raw) WHERE r NOT IN "
            "(SELECT trim(lower(sender_age_group)) FROM payments_raw WHERE sender_age_group IS NOT NULL)", "payments_raw"),
        "distinct_values": build("SELECT DISTINCT merchant_category, device_type FROM pairs_base", "pairs_base"),
    }


def _elt() -> dict[str, str]:
    s = "sender_age_category"
    joined = lambda sql: build(sql, "pairs_elt")
    marts = {
        "mart_age_spending_behavior": f"""SELECT {s} AS age_category, transaction_year AS year, transaction_month AS month,
            count(DISTINCT person_id) AS total_persons, {avg('age', digits=1)}, {avg('dependents', digits=1)},
            {avg('income', 'avg_monthly_income', 2)}, {avg('total_expenses', 'avg_monthly_expenses', 2)},
            {avg('expense_ratio', 'avg_expense_ratio_percent', 2)}, {avg('disposable_income', digits=2)}, {avg('desired_savings', digits=2)},
            {avg('savings_achievement_rate', 'avg_savings_achievement_percent', 2)}, {avg('total_potential_savings', 'avg_potential_savings', 2)},
            count(DISTINCT transaction_id) AS total_upi_transactions, {total('transaction_amount', 'total_upi_spending')},
            {avg('transaction_amount', digits=2)}, {lst(avg(c, digits=2) for c in ('groceries', 'eating_out', 'entertainment', 'transport', 'utilities', 'healthcare', 'discretionary_spending', 'essential_spending'))},
            {part("spending_type = 'Essential'", 'total_essential_upi')}, {part("spending_type = 'Discretionary'", 'total_discretionary_upi')},
            {avg('financial_health_score', digits=3)}, sum(fraud_flag) AS fraud_transaction_count, {pct('fraud_flag = 1', 'fraud_rate_percent')},
            {pct('is_weekend = 1', 'weekend_transaction_percent')}, {pct('is_high_value', 'high_value_transaction_percent')}
            FROM pairs_elt GROUP BY 1, 2, 3""",
        "mart_merchant_performance": f"""SELECT merchant_category, merchant_category_group, {s} AS age_category,
            count(DISTINCT transaction_id) AS transaction_count, count(DISTINCT person_id) AS unique_customers,
            {total('transaction_amount', 'total_revenue')}, {avg('transaction_amount', 'avg_transaction_value', 2)},
            CAST(min(transaction_amount) AS DOUBLE) AS min_transaction, CAST(max(transaction_amount) AS DOUBLE) AS max_transaction,
            {rnd('stddev_samp(transaction_amount)', 2)} AS stddev_transaction, {avg('income', 'avg_customer_income', 2)},
            {avg('disposable_income', 'avg_customer_disposable_income', 2)}, {avg('financial_health_score', 'avg_customer_financial_health', 3)},
            {avg('CASE WHEN is_weekend = 1 THEN transaction_amount ELSE 0 END', 'avg_weekend_value', 2)},
            {avg('CASE WHEN is_weekend = 0 THEN transaction_amount ELSE 0 END', 'avg_weekday_value', 2)},
            {pct("time_of_day_category = 'Evening'", 'evening_transaction_percent')}, {pct("transaction_status = 'SUCCESS'", 'success_rate_percent')},
            {avg('fraud_score')} FROM pairs_elt GROUP BY 1, 2, 3""",
        "mart_savings_opportunity": f"""SELECT {s} AS age_category, occupation_category, city_tier, income_bracket,
            count(DISTINCT person_id) AS person_count, {avg('age', digits=1)}, {avg('income', digits=2)}, {avg('total_expenses', 'avg_expenses', 2)},
            {avg('disposable_income', digits=2)}, {avg('savings_achievement_rate', 'current_savings_achievement_percent', 2)},
            {avg('desired_savings', digits=2)}, {avg('disposable_income - desired_savings', 'avg_savings_gap', 2)},
            {avg('total_potential_savings', 'total_potential_savings', 2)},
            {avg('potential_savings_groceries + potential_savings_eating_out', 'potential_food_savings', 2)},
            {avg('potential_savings_transport', 'potential_transport_savings', 2)}, {avg('potential_savings_entertainment', 'potential_entertainment_savings', 2)},
            {avg('potential_savings_utilities', 'potential_utilities_savings', 2)},
            {rnd('avg(total_potential_savings) / avg(total_expenses) * 100', 2)} AS potential_savings_percent,
            {avg('transaction_amount', 'avg_upi_transaction', 2)}, count(transaction_id) AS total_upi_transactions,
            {total('transaction_amount', 'total_upi_spending')}, {avg('discretionary_spending', 'avg_discretionary_spending_monthly', 2)},
            {part("spending_type = 'Discretionary'", 'total_discretionary_upi')}, {rnd(SCORE, 3)} AS savings_opportunity_score
            FROM pairs_elt GROUP BY 1, 2, 3, 4""",
        "mart_digital_payment_behavior": f"""SELECT {s} AS age_category, device_type, network_type, sender_state AS state,
            count(DISTINCT person_id) AS unique_users, count(DISTINCT transaction_id) AS total_transactions, {avg('transaction_amount', digits=2)},
            {n("transaction_type = 'p2p'", 'p2p_count')}, {n("transaction_type = 'p2m'", 'p2m_count')}, {n("transaction_type = 'bill payment'", 'bill_payment_count')},
            {avg('hour_of_day', 'avg_transaction_hour', 1)}, {pct('is_weekend = 1', 'weekend_usage_percent')},
            {pct("transaction_status = 'SUCCESS'", 'success_rate_percent')}, {avg('fraud_score')}, sum(fraud_flag) AS fraud_count,
            {avg('income', 'avg_user_income', 2)}, {avg('financial_health_score', 'avg_financial_health', 3)} FROM pairs_elt GROUP BY 1, 2, 3, 4""",
        "mart_monthly_trends": f"""SELECT transaction_year AS year, transaction_month AS month, {s} AS age_category,
            count(DISTINCT transaction_id) AS transactions, {total('transaction_amount', 'total_amount')}, {avg('transaction_amount', 'avg_amount', 2)},
            {avg('income', digits=2)}, {avg('total_expenses', 'avg_expenses', 2)}, {avg('disposable_income', digits=2)},
            {avg('savings_achievement_rate', 'avg_savings_rate', 2)}, {group_part('Food & Groceries', 'food_spending')},
            {group_part('Leisure', 'leisure_spending')}, {group_part('Transportation', 'transport_spending')},
            {group_part('Utilities & Bills', 'utilities_spending')}, {avg('financial_health_score', 'avg_financial_health', 3)},
            {pct('fraud_flag = 1', 'fraud_rate_percent')} FROM pairs_elt GROUP BY 1, 2, 3""",
    }
    keys = {
        "mart_age_spending_behavior": f"{s}, transaction_year, transaction_month",
        "mart_merchant_performance": f"merchant_category, merchant_category_group, {s}",
        "mart_savings_opportunity": f"{s}, occupation_category, city_tier, income_bracket",
        "mart_digital_payment_behavior": f"{s}, device_type, network_type, sender_state",
        "mart_monthly_trends": f"transaction_year, transaction_month, {s}",
    }
    check = lambda name, e, src: f"SELECT '{name}' AS check_name, {rnd(e)} AS value FROM {src}"
    global_checks = [
        *[check(k, e, "finance_elt") for k, e in {
            "finance_total_records": "count(*)", "null_person_id": "count(*) - count(person_id)", "null_age": "count(*) - count(age)",
            "null_income": "count(*) - count(income)", "min_age": "min(age)", "max_age": "max(age)", "min_income": "min(income)",
            "max_income": "max(income)", "avg_expense_ratio": "avg(expense_ratio)"}.items()],
        *[check(k, e, "payments_elt") for k, e in {
            "upi_total_records": "count(*)", "unique_transactions": "count(DISTINCT transaction_id)",
            "null_transaction_id": "count(*) - count(transaction_id)", "null_amount": "count(*) - count(amount_inr)",
            "null_status": "count(*) - count(transaction_status)", "min_amount": "min(amount_inr)", "max_amount": "max(amount_inr)",
            "avg_amount": "avg(amount_inr)", "min_hour": "min(hour_of_day)", "max_hour": "max(hour_of_day)",
            "duplicate_count": "count(*) - count(DISTINCT transaction_id)"}.items()],
        *[check(k, e, "pairs_elt") for k, e in {
            "total_integrated_records": "count(*)", "age_categories": f"count(DISTINCT {s})",
            "joined_unique_transactions": "count(DISTINCT transaction_id)", "joined_unique_persons": "count(DISTINCT person_id)"}.items()],
    ]
    payment_cols = lst(
        f"{rnd(c)} AS {c}" if c in ("transaction_amount", "fraud_score") else text(c) if c == "transaction_timestamp" else c
        for c in PAYMENT_ELT
    )
    return {k: joined(v) for k, v in marts.items()} | {
        "union_all_mart_counts": joined(" UNION ALL ".join(
            f"SELECT '{m}' AS mart_name, count(*) AS record_count FROM (SELECT DISTINCT {k} FROM pairs_elt)" for m, k in keys.items())),
        "age_category_spending_summary": joined(f"""SELECT {s}, transaction_year, transaction_month, count(DISTINCT transaction_id) AS total_transactions,
            {total('transaction_amount', 'total_transaction_value')}, {avg('transaction_amount')},
            CAST(min(transaction_amount) AS DOUBLE) AS min_transaction_amount, CAST(max(transaction_amount) AS DOUBLE) AS max_transaction_amount,
            {rnd('stddev_samp(transaction_amount)')} AS stddev_transaction_amount, {group_part('Food & Groceries', 'food_groceries_spending')},
            {group_part('Leisure', 'leisure_spending')}, {group_part('Transportation', 'transport_spending')},
            {group_part('Health & Insurance', 'health_spending')}, {group_part('Utilities & Bills', 'utilities_spending')},
            {part("spending_type = 'Essential'", 'essential_upi_spending')}, {part("spending_type = 'Discretionary'", 'discretionary_upi_spending')},
            {n('fraud_flag = 1', 'fraud_transaction_count')}, {pct('fraud_flag = 1', 'fraud_percentage', 4)},
            {n('is_weekend = 1', 'weekend_transactions')}, {pct('is_weekend = 1', 'weekend_transaction_percentage', 4)},
            {lst(avg(c) for c in ('income', 'total_expenses', 'disposable_income', 'desired_savings', 'savings_achievement_rate', 'financial_health_score', 'expense_ratio'))}
            FROM pairs_elt GROUP BY 1, 2, 3"""),
        "merchant_category_analysis": joined(f"""SELECT {s}, merchant_category, merchant_category_group, count(DISTINCT transaction_id) AS transaction_count,
            count(DISTINCT person_id) AS unique_persons, {total('transaction_amount', 'total_amount')}, {avg('transaction_amount', 'avg_amount')},
            {rnd('median(CAST(transaction_amount AS DOUBLE))')} AS median_amount,
            {avg('CASE WHEN is_weekend = 1 THEN transaction_amount END', 'avg_weekend_amount')}, {avg('CASE WHEN is_weekend = 0 THEN transaction_amount END', 'avg_weekday_amount')},
            {avg('financial_health_score', 'avg_financial_health')}, {avg('savings_achievement_rate', 'avg_savings_rate')}, {avg('disposable_income')},
            {avg("CASE WHEN time_of_day_category = 'Evening' THEN 1 ELSE 0 END", 'evening_transaction_ratio')}, {avg('fraud_flag', 'fraud_rate')}
            FROM pairs_elt GROUP BY 1, 2, 3"""),
        "occupation_spending_analysis": joined(f"""SELECT occupation_category, {s}, city_tier, count(DISTINCT person_id) AS person_count, {avg('age')}, {avg('dependents')},
            {avg('income')}, {avg('total_expenses', 'avg_expenses')}, {avg('disposable_income')}, {avg('savings_achievement_rate', 'avg_savings_rate')},
            count(transaction_id) AS total_upi_transactions, {total('transaction_amount', 'total_upi_spending')}, {avg('transaction_amount', 'avg_upi_transaction')},
            {lst(avg(c, f'avg_{c}_expense') for c in ('groceries', 'eating_out', 'entertainment', 'transport', 'utilities'))},
            {avg('total_potential_savings', 'avg_potential_savings')},
            {rnd('avg(total_potential_savings) / avg(total_expenses) * 100')} AS potential_savings_percentage FROM pairs_elt GROUP BY 1, 2, 3"""),
        "time_based_spending_patterns": joined(f"""SELECT g.*, m.merchant_category AS most_common_category FROM (
            SELECT {s}, time_of_day_category, is_weekend, day_of_week, count(*) AS transaction_count, {total('transaction_amount', 'total_amount')},
            {avg('transaction_amount', 'avg_amount')}, count(DISTINCT merchant_category) AS distinct_categories, {avg('income')}, {avg('disposable_income')},
            {avg('financial_health_score', 'avg_financial_health')}, sum(fraud_flag) AS fraud_count, {avg('fraud_score')} FROM pairs_elt GROUP BY 1, 2, 3, 4) g
            LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {s}, time_of_day_category, is_weekend, day_of_week ORDER BY k DESC, merchant_category) AS rn FROM (
              SELECT {s}, time_of_day_category, is_weekend, day_of_week, merchant_category, count(*) AS k FROM pairs_elt
              WHERE merchant_category IS NOT NULL GROUP BY 1, 2, 3, 4, 5)) m
            ON m.rn = 1 AND g.{s} = m.{s} AND g.time_of_day_category = m.time_of_day_category AND g.is_weekend = m.is_weekend AND g.day_of_week = m.day_of_week"""),
        "fact_spending_behavior_agg": joined(f"""SELECT {s} AS age_category, merchant_category, transaction_year AS year, transaction_month AS month,
            count(*) AS total_transactions, {total('transaction_amount', 'total_amount')}, {avg('transaction_amount', digits=2)},
            CAST(min(transaction_amount) AS DOUBLE) AS min_transaction_amount, CAST(max(transaction_amount) AS DOUBLE) AS max_transaction_amount,
            {avg('income', digits=2)}, {avg('disposable_income - desired_savings', 'avg_savings', 2)}, {avg('disposable_income', digits=2)},
            {n('fraud_flag = 1', 'fraud_transaction_count')}, {pct('fraud_flag = 1', 'fraud_percentage')}, {pct('is_weekend = 1', 'weekend_transaction_percentage')}
            FROM pairs_elt GROUP BY 1, 2, 3, 4"""),
        "integrated_spending_savings": joined(
            f"SELECT {payment_cols}, count(*) AS person_rows, count(DISTINCT person_id) AS unique_persons, {lst(avg(c) for c in PERSON_ELT)} FROM pairs_elt GROUP BY {lst(PAYMENT_ELT)}"),
        "join_coverage": joined(f"SELECT {s}, count(*) AS record_count, count(DISTINCT transaction_id) AS transaction_count, count(DISTINCT person_id) AS person_count FROM pairs_elt GROUP BY 1"),
        "global_checks": joined(" UNION ALL ".join(global_checks)),
        "order_by_group": build(f"SELECT age_category, count(*) AS record_count, {avg('income')}, {avg('total_expenses', 'avg_expenses')} FROM finance_elt GROUP BY 1 ORDER BY 1", "finance_elt"),
        "distribution_by_category": build(f"SELECT {s}, count(*) AS transaction_count, {avg('amount_inr', 'avg_transaction_amount')}, {n('fraud_flag = 1', 'fraud_count')} FROM payments_elt GROUP BY 1 ORDER BY 1", "payments_elt"),
    }


def _etl() -> dict[str, str]:
    p = lambda sql: build(sql, "pairs_etl")
    pay = lst(rnd(c) + f" AS {c}" if c in ("amount", "amount_normalized") else text(c) if c == "transaction_timestamp" else c for c in ETL_PAYMENT)
    fact_sums = (
        "income disposable_income desired_savings groceries transport eating_out entertainment utilities healthcare education "
        "miscellaneous potential_savings_groceries potential_savings_transport potential_savings_eating_out potential_savings_entertainment"
    ).split()
    fact = lambda sql, *more: build(sql, "fact", *more)
    age_merchant = "fact f JOIN dim_age a USING (age_category_id) JOIN dim_merchant m USING (merchant_category_id)"
    top = f"""SELECT a.age_category, m.category_name, count(f.transaction_id) AS transaction_count,
        {avg('f.savings_opportunity_score', 'avg_savings_opportunity')}, {total(FOUR, 'total_potential_savings')}
        FROM {age_merchant} WHERE f.savings_opportunity_score > 0 GROUP BY 1, 2 HAVING sum({FOUR}) > 1000"""
    monthly = f"""SELECT d.year, d.month, d.month_name, count(f.transaction_id) AS transaction_count, {total('f.amount', 'total_spending')},
        {avg('f.amount', 'avg_transaction_amount')}, {total(FOUR, 'total_potential_savings')} FROM fact f JOIN dim_day d USING (date_id) GROUP BY 1, 2, 3"""
    null_check = lambda c: (
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, {rnd(f'(count(*) - count({c})) * 100.0::DOUBLE / count(*)', 2)} AS null_percentage, count(*) = count({c}) AS passed FROM ")
    null_columns = [
        *ETL_PAYMENT, "weekend_spending_impact", "age_transaction_pattern", "digital_adoption_score", "finance_id", "occupation", "city_tier", *ETL_PERSON,
        "spending_income_ratio", "high_savings_category", "financial_health_score", "is_affordable_transaction", "savings_opportunity_score",
    ]
    range_check = lambda c, lo, hi: (
        f"SELECT '{c}' AS \"column\", {lo}::DOUBLE AS min_allowed, {hi}::DOUBLE AS max_allowed, {n(f'{c} < {lo} OR {c} > {hi}', 'out_of_range_count')}, "
        f"{rnd(f'count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) * 100.0::DOUBLE / count({c})', 2)} AS out_of_range_percentage, "
        f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) = 0 AS passed FROM pairs_base")
    limits = (("amount", 0, 100000), ("age", 18, 100), ("income", 0, 500000))
    dist = lambda c: (
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", {avg(c, 'mean')}, {rnd(f'stddev_samp({c})')} AS stddev, {rnd(f'min({c})')} AS min_value, "
        f"{rnd(quantile(c, 0.25))} AS p25, {rnd(quantile(c, 0.5))} AS p50, {rnd(quantile(c, 0.75))} AS p75, {rnd(f'max({c})')} AS max_value, "
        f"abs(avg({c}) - {quantile(c, 0.5)}) / stddev_samp({c}) > 1 AS is_skewed, true AS passed FROM pairs_base")
    unique = lambda c, src, stage: (
        f"SELECT '{c}' AS \"column\", count(*) AS total_count, count(DISTINCT {c}) AS distinct_count, count(*) - count(DISTINCT {c}) AS duplicate_count, "
        f"{rnd(f'count(DISTINCT {c}) * 100.0::DOUBLE / count(*)', 2)} AS uniqueness_percentage, count(*) = count(DISTINCT {c}) AS passed, '{stage}' AS stage FROM {src}")
    passes = " UNION ALL ".join([
        "SELECT count(*) = count(DISTINCT transaction_id) AS passed FROM pairs_base",
        *[f"SELECT count(*) = count({c}) FROM pairs_etl" for c in null_columns],
        *[f"SELECT count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) = 0 FROM pairs_base" for c, lo, hi in limits],
        "SELECT true FROM range(6)",  # three types and three distributions, which always pass
    ])
    orphan = lambda child, src, parent: (
        f"SELECT '{child}' AS parent_column, '{child}' AS child_column, count(*) AS orphan_count, count(*) = 0 AS passed FROM "
        f"(SELECT DISTINCT {child} AS v FROM {src} WHERE {child} IS NULL OR {child} NOT IN (SELECT {child} FROM {parent}))")
    return {
        "joined_features_etl": p(f"""SELECT transaction_id, age_category, merchant_category, {rnd('amount')} AS amount,
            {rnd('weekend_spending_impact')} AS weekend_spending_impact, age_transaction_pattern, {rnd('digital_adoption_score')} AS digital_adoption_score,
            count(*) AS person_rows, {avg('spending_income_ratio')}, {avg('high_savings_category')}, {avg('financial_health_score')},
            {n('is_affordable_transaction', 'affordable_persons')}, {avg('savings_opportunity_score')}
            FROM pairs_etl GROUP BY transaction_id, age_category, merchant_category, amount, pairs_etl.weekend_spending_impact, age_transaction_pattern, pairs_etl.digital_adoption_score"""),
        "join_age_category_inner": build(f"SELECT {pay}, count(*) AS person_rows, {lst(avg(c) for c in ETL_PERSON)} FROM pairs_base GROUP BY {lst(ETL_PAYMENT)}", "pairs_base"),
        "agg_age_merchant": p(f"""SELECT age_category, merchant_category, count(transaction_id) AS transaction_count, {total('amount', 'total_amount')}, {avg('amount')},
            {n('fraud_flag = 1', 'fraud_count')}, {avg('financial_health_score', 'avg_financial_health')}, {avg('savings_opportunity_score', 'avg_savings_opportunity')},
            {avg('income')}, {avg('disposable_income')} FROM pairs_etl GROUP BY 1, 2"""),
        "dim_age_category": build("SELECT *, 'Age group: ' || age_range AS description FROM dim_age", "dim_age"),
        "dim_occupation": build("SELECT *, 'Primary' AS occupation_type FROM dim_occ", "dim_occ"),
        "dim_merchant_category": build("SELECT *, 'UPI' AS category_type FROM dim_merchant", "dim_merchant"),
        "dim_location": build("SELECT * FROM dim_place", "dim_place"),
        "dim_date": build("SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_day", "dim_day"),
        "fact_spending_pattern": fact(f"""SELECT transaction_year, transaction_month, age_category_id, occupation_id, merchant_category_id, city_tier,
            count(*) AS fact_rows, {total('amount', 'transaction_amount')}, sum(fraud_flag) AS fraud_flag, {lst(total(c, c) for c in fact_sums)},
            {lst(f'{rnd(f"sum({c})")} AS {c}' for c in ('spending_income_ratio', 'financial_health_score', 'savings_opportunity_score'))}
            FROM fact GROUP BY 1, 2, 3, 4, 5, 6"""),
        "join_fact_to_dims": fact(f"""SELECT age_category_id, merchant_category_id, location_id, count(*) AS fact_rows, {total('amount', 'transaction_amount')} FROM fact GROUP BY 1, 2, 3"""),
        "join_fact_age_merchant": fact(f"SELECT a.age_category, m.category_name, count(*) AS fact_rows, {total('f.amount', 'transaction_amount')} FROM {age_merchant} GROUP BY 1, 2"),
        "join_fact_date": fact(f"""SELECT CAST(d.full_date AS VARCHAR) AS full_date, d.day_of_week, d.is_weekend, count(*) AS transaction_count,
            {total('f.amount', 'total_spending')}, {total(FOUR, 'total_potential_savings')} FROM fact f JOIN dim_day d USING (date_id) GROUP BY d.full_date, d.day_of_week, d.is_weekend""", "dim_day"),
        "join_fact_occ_loc": fact(f"""SELECT o.occupation_name, l.state, l.city_tier, l.region, count(*) AS fact_rows, {total('f.amount', 'transaction_amount')}
            FROM fact f JOIN dim_occ o USING (occupation_id) JOIN dim_place l USING (location_id) GROUP BY 1, 2, 3, 4""", "dim_occ"),
        "v_spending_by_age": fact(f"""SELECT a.age_category, a.age_range, m.category_name AS merchant_category, count(f.transaction_id) AS transaction_count,
            {total('f.amount', 'total_spending')}, {avg('f.amount', 'avg_transaction_amount')}, {avg('f.financial_health_score', 'avg_financial_health')},
            {avg('f.savings_opportunity_score', 'avg_savings_opportunity')}, {n('f.fraud_flag = 1', 'fraud_transactions')} FROM {age_merchant} GROUP BY 1, 2, 3"""),
        "v_monthly_spending_trends": fact(monthly, "dim_day"),
        "monthly_trends_year": fact(f"SELECT * FROM ({monthly}) WHERE year = 1995", "dim_day"),
        "v_financial_health_analysis": fact(f"""SELECT o.occupation_name, l.city_tier, count(DISTINCT f.transaction_id) AS transaction_count, {avg('f.income', 'avg_income')},
            {avg('f.disposable_income', 'avg_disposable_income')}, {avg('f.financial_health_score', 'avg_financial_health_score')},
            {avg('f.spending_income_ratio', 'avg_spending_income_ratio')} FROM fact f JOIN dim_occ o USING (occupation_id) JOIN dim_place l USING (location_id) GROUP BY 1, 2""", "dim_occ"),
        "v_top_savings_opportunities": fact(top),
        "top_savings_topk": fact(f"SELECT * FROM ({top}) WHERE avg_savings_opportunity > 10 ORDER BY total_potential_savings DESC, age_category, category_name LIMIT 10"),
        "avg_spending_by_age": fact(f"SELECT a.age_category, {avg('f.amount', 'avg_spending')}, count(*) AS transaction_count FROM fact f JOIN dim_age a USING (age_category_id) GROUP BY 1"),
        "dq_uniqueness": build(" UNION ALL ".join((
            unique("transaction_id", "payments_etl", "payments"), unique("sender_state", "payments_etl", "payments"),
            unique("transaction_id", "pairs_base", "joined"))), "pairs_base"),
        "dq_nulls": build(" UNION ALL ".join(null_check(c) + "pairs_etl" for c in null_columns), "pairs_etl"),
        "dq_nulls_raw": build(" UNION ALL ".join(null_check(c).replace("count(timestamp)", 'count("timestamp")') + "payments_raw" for c in RAW_PAYMENT), "payments_raw"),
        "dq_range": build(" UNION ALL ".join(range_check(*x) for x in limits), "pairs_base"),
        "dq_distribution": build(" UNION ALL ".join(dist(c) for c in ("amount", "income", "disposable_income")), "pairs_base"),
        "dq_report": build(
            f"SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks, count(*) FILTER (WHERE NOT passed) AS failed_checks, "
            f"{rnd('count(*) FILTER (WHERE passed) * 100.0::DOUBLE / count(*)', 2)} AS quality_score FROM ({passes})", "pairs_etl"),
        "dq_referential": fact(" UNION ALL ".join((
            orphan("merchant_category_id", "fact", "dim_merchant"), orphan("age_category_id", "fact", "dim_age"), orphan("date_id", "fact", "dim_day"),
            orphan("occupation_id", "fact", "dim_occ"),
            "SELECT 'sender_age_group', 'receiver_age_group', count(*), count(*) = 0 FROM (SELECT DISTINCT trim(lower(receiver_age_group)) AS r FROM payments_raw) "
            "WHERE r IS NULL OR r NOT IN (SELECT trim(lower(sender_age_group)) FROM payments_raw WHERE sender_age_group IS NOT NULL)")), "dim_day", "dim_occ", "payments_raw"),
    }


def row_id(columns: list[str], of: str = "") -> str:
    """The surrogate key of a row: the first 60 bits of the md5 of its columns."""
    parts = (f"CAST({of}{c} AS VARCHAR)" for c in columns)
    return f"CAST('0x' || substr(md5({' || '.join(key_part(p) for p in parts)}), 1, 15) AS BIGINT)"


def _star() -> dict[str, str]:
    s_age = "SELECT row_number() OVER (ORDER BY age_range) AS age_group_sk, age_range, age_category FROM (SELECT DISTINCT age_range, age_category FROM finance_elt)"
    types = f"SELECT CAST('0x' || substr(md5({key_part('transaction_type')}), 1, 15) AS BIGINT) AS transaction_type_sk, transaction_type, transaction_type_category AS transaction_category FROM (SELECT DISTINCT transaction_type, transaction_type_category FROM payments_elt)"
    merchants = f"SELECT CAST('0x' || substr(md5({key_part('merchant_category')}), 1, 15) AS BIGINT) AS merchant_category_sk, * FROM (SELECT merchant_category, merchant_category_group AS category_group, spending_type = 'Essential' AS is_essential, {avg('amount_inr', 'avg_transaction_amount', 2)} FROM payments_elt GROUP BY 1, 2, 3)"
    places = f"SELECT CAST('0x' || substr(md5({key_part('sender_state')}), 1, 15) AS BIGINT) AS location_sk, sender_state AS state_name FROM (SELECT DISTINCT sender_state FROM payments_elt)"
    null = lambda kind, name: f"CAST(NULL AS {kind}) AS {name}"
    fiscal = "CAST(full_date AS DATE) - INTERVAL 3 MONTH"
    return {
        "star_dim_age_group": build(
            f"""SELECT *, TRY_CAST(substr(age_range, 1, 2) AS INT) AS min_age, TRY_CAST(substr(age_range, 4, 2) AS INT) AS max_age, {null('VARCHAR', 'generation')} FROM ({s_age})""", "finance_elt"),
        "star_dim_person": build(
            "SELECT CAST(person_id AS BIGINT) AS person_sk, person_id, age, age_category, dependents, occupation, occupation_category, city_tier, income_bracket, "
            "occupation_category AS occupation_type FROM finance_elt", "finance_elt"),
        "star_dim_transaction_type": build(f"SELECT *, {null('VARCHAR', 'description')} FROM ({types})", "payments_elt"),
        "star_dim_merchant_category": build(merchants, "payments_elt"),
        "star_dim_date": build(
            f"""SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_sk, CAST(full_date AS VARCHAR) AS full_date, year(full_date) AS year, quarter(full_date) AS quarter,
            month(full_date) AS month, monthname(full_date) AS month_name, weekofyear(full_date) AS week_of_year, day(full_date) AS day_of_month,
            dayofweek(full_date) + 1 AS day_of_week, dayname(full_date) AS day_name, dayofweek(full_date) IN (0, 6) AS is_weekend, {null('BOOLEAN', 'is_holiday')},
            year({fiscal}) AS fiscal_year, quarter({fiscal}) AS fiscal_quarter
            FROM (SELECT DISTINCT CAST(transaction_timestamp AS DATE) AS full_date FROM payments_elt)""", "payments_elt"),
        "star_dim_location": build(f"SELECT *, {null('VARCHAR', 'region')}, {null('VARCHAR', 'tier')}, {null('VARCHAR', 'population_category')} FROM ({places})", "payments_elt"),
        "star_fact_personal_finance": build(
            f"""SELECT {row_id(['person_id', *[c for c in FINANCE if c != 'id']])} AS finance_fact_sk, CAST(person_id AS BIGINT) AS person_sk, age_group_sk,
            {null('INT', 'location_sk')}, 20240131 AS date_sk, {lst(f'CAST({c} AS DOUBLE) AS {c}' for c in [*NUMERIC, 'total_expenses', 'total_potential_savings'])},
            {null('DOUBLE', 'actual_savings')}, {null('DOUBLE', 'savings_rate')}, 2024 AS year, 1 AS month
            FROM finance_elt JOIN ({s_age}) USING (age_range)""", "finance_elt"),
        "star_fact_upi_transaction": build(
            f"""SELECT {row_id(['transaction_id', 'transaction_timestamp', *[c for c in RAW_PAYMENT if c not in ('transaction_id', 'timestamp')]], 'u.')} AS transaction_fact_sk, transaction_id, transaction_type_sk, merchant_category_sk,
            a.age_group_sk AS sender_age_group_sk, b.age_group_sk AS receiver_age_group_sk, location_sk AS sender_location_sk,
            CAST(strftime(transaction_timestamp, '%Y%m%d') AS INT) AS date_sk, {text('transaction_timestamp')}, CAST(amount_inr AS DOUBLE) AS amount_inr, transaction_status,
            sender_bank, receiver_bank, device_type, network_type, fraud_flag, {rnd('fraud_score')} AS fraud_score, hour_of_day, day_of_week, is_weekend,
            time_of_day_category, transaction_year AS year, transaction_month AS month, transaction_status AS status
            FROM payments_elt u LEFT JOIN ({s_age}) a ON u.sender_age_category = a.age_category LEFT JOIN ({s_age}) b ON u.receiver_age_category = b.age_category
            LEFT JOIN ({types}) t USING (transaction_type) LEFT JOIN ({merchants}) m ON u.merchant_category IS NOT DISTINCT FROM m.merchant_category
            LEFT JOIN ({places}) l ON u.sender_state = l.state_name""", "payments_elt", "finance_elt"),
        "scd1_upsert_person": build(
            "SELECT person_id, CASE WHEN person_id % 3 = 0 THEN age + 1 ELSE age END AS age, occupation, city_tier, "
            "CASE WHEN person_id % 3 = 0 THEN '2024-02-01' ELSE '2024-01-01' END AS updated_at FROM finance_elt", "finance_elt"),
    }


def _streams() -> dict[str, str]:
    slot = "time_bucket(INTERVAL 5 MINUTE, CAST(\"timestamp\" AS TIMESTAMP))"
    known = "FROM payments_raw WHERE \"timestamp\" IS NOT NULL"
    counted = {
        "stream_passthrough": build("SELECT id, CAST(income AS DOUBLE) AS income, age, occupation, '2024-01-01 00:00:00' AS kafka_timestamp FROM finance_raw", "finance_raw"),
        "stream_tumbling_count": build(
            f"SELECT CAST({slot} AS VARCHAR) AS window_start, CAST({slot} + INTERVAL 5 MINUTE AS VARCHAR) AS window_end, transaction_status, sender_age_group, "
            f"count(*) AS \"count\" {known} GROUP BY ALL", "payments_raw"),
        "stream_event_counts": "SELECT CAST(time_bucket(INTERVAL 5 MINUTE, ts) AS VARCHAR) AS window_start, event_type, count(*) AS \"count\" FROM events GROUP BY ALL",
        "stream_land_raw": build(
            f"SELECT transaction_id, CAST(amount_inr AS DOUBLE) AS amount_inr, CAST(substr(\"timestamp\", 1, 4) AS INT) AS year, "
            f"CAST(substr(\"timestamp\", 6, 2) AS INT) AS month, upper(trim(transaction_status)) AS status {known}", "payments_raw"),
    }
    # late records count for nothing, and a restart counts nothing twice
    return counted | {"stream_late_drop": counted["stream_tumbling_count"], "stream_restart": counted["stream_tumbling_count"]}


def _loads() -> dict[str, str]:
    persons = build(
        f"SELECT occupation, city_tier, age_category, count(*) AS persons, {total('income', 'total_income')}, {total('total_potential_savings', 'total_potential_savings')}, "
        f"{avg('total_expenses', 'avg_expenses', 2)} FROM finance_elt GROUP BY 1, 2, 3", "finance_elt")
    return {
        "bucket_join_persons": persons, "map_join_by_size": persons,
        "bucket_join_payments": build(
            f"SELECT merchant_category, sender_age_group, receiver_age_group, count(*) AS payments, {total('amount_inr', 'total_amount')}, "
            f"{rnd('max(fraud_score)')} AS max_fraud_score FROM payments_elt GROUP BY 1, 2, 3", "payments_elt"),
        "upsert_touched_buckets": build(
            "SELECT person_id, CASE WHEN occupation = 'retired' THEN age + 1 ELSE age END AS age, occupation, "
            "CASE WHEN occupation = 'retired' THEN 'tier_9' ELSE city_tier END AS city_tier, "
            "CASE WHEN occupation = 'retired' THEN '2024-02-01' ELSE '2024-01-01' END AS updated_at FROM finance_elt", "finance_elt"),
        "scd1_changed_only": build(
            "SELECT person_id, CASE WHEN city_tier = 'tier_2' THEN age + 1 ELSE age END AS age, occupation, city_tier, "
            "(SELECT count(*) FROM finance_elt WHERE city_tier = 'tier_2') AS rows_changed, CAST(0 AS BIGINT) AS rows_changed_again FROM finance_elt", "finance_elt"),
        "behavior_agg_incremental": _elt()["fact_spending_behavior_agg"],
        "src_json_quarantine": build(
            f"""SELECT 'good' AS reason, count(*) AS records, {total('amount_inr', 'total_amount')} FROM payments_raw WHERE hour_of_day NOT IN (3, 5, 7)
            UNION ALL SELECT CASE hour_of_day WHEN 3 THEN 'malformed' WHEN 5 THEN 'empty value' ELSE 'no key' END, count(*), NULL
            FROM payments_raw WHERE hour_of_day IN (3, 5, 7) GROUP BY hour_of_day""", "payments_raw"),
        "audit_of_loads": build(
            "SELECT 'clean_india_personal_finance' AS table_name, 'INITIAL_LOAD' AS operation, (SELECT count(*) FROM finance_elt) AS record_count, 'SUCCESS' AS status, false AS failed "
            "UNION ALL SELECT 'clean_upi_transaction', 'INITIAL_LOAD', (SELECT count(*) FROM payments_elt), 'SUCCESS', false "
            "UNION ALL SELECT 'clean_india_personal_finance', 'RELOAD', NULL, 'FAILED', true", "finance_elt", "payments_elt"),
        "cat_column_stats": build(" UNION ALL ".join(
            f"SELECT 'clean_payments' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
            + ("CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, " if c == "transaction_id" else f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, ")
            + f"true AS distinct_within_15_percent, {'false' if c == 'transaction_id' else 'true'} AS histogram FROM payments_elt"
            for c in ("transaction_id", "amount_inr", "hour_of_day", "is_weekend", "fraud_flag", "transaction_year", "transaction_month")), "payments_elt"),
        "dq_distribution_sketch": build(
            "SELECT c AS \"column\", (SELECT count(*) FROM payments_elt) AS \"count\", p AS prob, true AS close "
            "FROM (VALUES ('amount'), ('hour_of_day')) a(c), (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) b(p)", "payments_elt"),
        "append_fact_once": build(
            f"SELECT transaction_year, transaction_month, transaction_status, count(*) AS payments, count(DISTINCT transaction_id) AS ids, "
            f"{total('amount_inr', 'total_amount')} FROM payments_elt GROUP BY 1, 2, 3", "payments_elt"),
    }


def statements() -> dict[str, str]:
    return _loads() | _sources() | _cleaning() | _elt() | _etl() | _star() | _streams()


assert len(POTENTIALS) == 8
