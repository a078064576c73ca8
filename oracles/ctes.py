"""Common table expressions the oracle statements start from.

Written from the rules, not from the Spark code: cleaning in one pass per
profile, and joined tables as plain joins that really make every pair.
"""

from .adapter import FINANCE_REPEATED, FINANCE_SQL, PAYMENTS_REPEATED, PAYMENTS_SQL

EXPENSES = (
    "rent loan_repayment insurance groceries transport eating_out entertainment utilities healthcare "
    "education miscellaneous"
).split()
POTENTIALS = [
    f"potential_savings_{n}"
    for n in "groceries transport eating_out entertainment utilities healthcare education miscellaneous".split()
]
NUMERIC = ["income", *EXPENSES, "desired_savings_percentage", "desired_savings", "disposable_income", *POTENTIALS]
FINANCE = ["id", "income", "age", "dependents", "occupation", "city_tier", *NUMERIC[1:]]


def rnd(expression: str, digits: int = 4) -> str:
    """Half-up rounding in decimals, as a double."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def quantile(column: str, p: float) -> str:
    """The element at rank ceil(p * n) of the non-NULL values."""
    present = f"FILTER (WHERE {column} IS NOT NULL)"
    return f"list_sort(list({column}) {present})[greatest(CAST(ceil({p} * count({column})) AS BIGINT), 1)]"


def key_part(c: str) -> str:
    """A column's part of the text that a surrogate key is the digest of."""
    return f"coalesce(length({c}) || ':' || {c}, '~')"


def _zero(c: str) -> str:
    return f"coalesce({c}, 0) AS {c}"


def _floor0(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN 0 ELSE coalesce({c}, 0) END AS {c}"


def age_band(age: str, labels: tuple[str, ...]) -> str:
    a, b, c, d, e = labels
    return (
        f"CASE WHEN {age} BETWEEN 18 AND 25 THEN '{a}' WHEN {age} BETWEEN 26 AND 35 THEN '{b}' "
        f"WHEN {age} BETWEEN 36 AND 45 THEN '{c}' WHEN {age} BETWEEN 46 AND 55 THEN '{d}' "
        f"WHEN {age} >= 56 THEN '{e}' ELSE 'Unknown' END"
    )


CATEGORIES = ("Teenagers", "Young Adult", "Early Middle Age", "Late Middle Age", "Seniors")
RANGES = ("18-25", "26-35", "36-45", "46-55", "56+")


def group_category(c: str, loose: bool) -> str:
    arms = " ".join(f"WHEN {c} = '{r}' THEN '{k}'" for r, k in zip(RANGES, CATEGORIES))
    extra = f" WHEN {c} LIKE '%56%' THEN 'Seniors'" if loose else ""
    return f"CASE {arms}{extra} ELSE 'Unknown' END"


_ELT_TEXT = "transaction_type merchant_category sender_state sender_bank receiver_bank device_type network_type day_of_week"
_ETL_FILL = {
    "transaction_type": "unknown", "merchant_category": "other", "transaction_status": "unknown",
    "sender_age_group": "unknown", "receiver_age_group": "unknown", "sender_state": "unknown",
    "device_type": "unknown", "network_type": "unknown", "sender_bank": None, "receiver_bank": None,
    "day_of_week": None,
}


def _etl_text(c: str, default: str | None) -> str:
    clean = f"trim(lower({c}))"
    return f"{clean} AS {c}" if default is None else f"coalesce({clean}, '{default}') AS {c}"


_FINANCE_ELT = f"""
SELECT DISTINCT *, {age_band('age', CATEGORIES)} AS age_category, {age_band('age', RANGES)} AS age_range,
  CASE occupation WHEN 'self_employed' THEN 1 WHEN 'professional' THEN 2 WHEN 'retired' THEN 3 WHEN 'student' THEN 4 ELSE 0 END AS occupation_code,
  CASE WHEN occupation IN ('self_employed','professional') THEN 'Working' WHEN occupation = 'retired' THEN 'Retired'
       WHEN occupation = 'student' THEN 'Student' ELSE 'Other' END AS occupation_category,
  CASE city_tier WHEN 'tier_1' THEN 1 WHEN 'tier_2' THEN 2 WHEN 'tier_3' THEN 3 ELSE 0 END AS city_tier_code,
  CASE WHEN income > 0 THEN (CAST(income AS DOUBLE) - 5000) / 145000 ELSE 0 END AS income_normalized,
  CASE WHEN disposable_income > 0 THEN (CAST(disposable_income AS DOUBLE) + 10000) / 90000 ELSE 0 END AS disposable_income_normalized,
  CASE WHEN income < 20000 THEN 'Low Income' WHEN income BETWEEN 20000 AND 50000 THEN 'Middle Income'
       WHEN income BETWEEN 50001 AND 100000 THEN 'Upper Middle Income' ELSE 'High Income' END AS income_bracket,
  CASE WHEN income > 0 THEN CAST(total_expenses AS DOUBLE) / CAST(income AS DOUBLE) * 100 ELSE 0 END AS expense_ratio,
  CASE WHEN desired_savings > 0 THEN CAST(disposable_income AS DOUBLE) / CAST(desired_savings AS DOUBLE) * 100 ELSE 0 END AS savings_achievement_rate,
  eating_out + entertainment AS discretionary_spending,
  rent + groceries + utilities + healthcare AS essential_spending,
  CASE WHEN income > 0 THEN CAST(disposable_income AS DOUBLE) / CAST(income AS DOUBLE) * 0.4::DOUBLE
       + CAST(total_potential_savings AS DOUBLE) / nullif(CAST(total_expenses AS DOUBLE), 0) * 0.3::DOUBLE
       + CASE WHEN dependents = 0 THEN 0.15::DOUBLE ELSE 0.05::DOUBLE END
       + CASE WHEN loan_repayment = 0 THEN 0.15::DOUBLE ELSE 0.05::DOUBLE END ELSE 0 END AS financial_health_score
FROM (SELECT *, {' + '.join(EXPENSES)} AS total_expenses, {' + '.join(POTENTIALS)} AS total_potential_savings
      FROM finance_std) WHERE person_id IS NOT NULL AND age > 0 AND income >= 0
"""

_PAYMENTS_ELT = f"""
SELECT DISTINCT *,
  {group_category('sender_age_group', True)} AS sender_age_category,
  {group_category('receiver_age_group', True)} AS receiver_age_category,
  year(transaction_timestamp) AS transaction_year, month(transaction_timestamp) AS transaction_month,
  day(transaction_timestamp) AS transaction_day,
  CASE WHEN hour_of_day BETWEEN 0 AND 5 THEN 'Late Night' WHEN hour_of_day BETWEEN 6 AND 11 THEN 'Morning'
       WHEN hour_of_day BETWEEN 12 AND 17 THEN 'Afternoon' WHEN hour_of_day BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END AS time_of_day_category,
  is_weekend = 1 AS is_weekend_flag, (hour_of_day BETWEEN 9 AND 17) AND is_weekend = 0 AS is_business_hours,
  CASE WHEN merchant_category IN ('food','grocery','eating_out') THEN 'Food & Groceries'
       WHEN merchant_category IN ('entertainment','shopping') THEN 'Leisure'
       WHEN merchant_category IN ('fuel','transport') THEN 'Transportation'
       WHEN merchant_category IN ('healthcare','insurance') THEN 'Health & Insurance'
       WHEN merchant_category = 'education' THEN 'Education'
       WHEN merchant_category IN ('utilities','bill payment','recharge') THEN 'Utilities & Bills' ELSE 'Other' END AS merchant_category_group,
  CASE WHEN merchant_category IN ('food','grocery','healthcare','utilities','fuel','education') THEN 'Essential' ELSE 'Discretionary' END AS spending_type,
  CASE transaction_type WHEN 'p2p' THEN 'Person to Person' WHEN 'p2m' THEN 'Person to Merchant'
       WHEN 'bill payment' THEN 'Bill Payment' WHEN 'recharge' THEN 'Recharge' ELSE 'Other' END AS transaction_type_category,
  CASE WHEN amount_inr > 0 THEN (CAST(amount_inr AS DOUBLE) - 10) / 49990 ELSE 0 END AS amount_normalized,
  CASE transaction_status WHEN 'SUCCESS' THEN 1 WHEN 'FAILED' THEN 0 ELSE -1 END AS transaction_status_code,
  CASE device_type WHEN 'android' THEN 1 WHEN 'ios' THEN 2 WHEN 'web' THEN 3 ELSE 0 END AS device_type_code,
  CASE network_type WHEN '5g' THEN 4 WHEN '4g' THEN 3 WHEN 'wifi' THEN 2 WHEN '3g' THEN 1 ELSE 0 END AS network_type_code,
  CASE WHEN amount_inr < 100 THEN 'Micro' WHEN amount_inr BETWEEN 100 AND 500 THEN 'Small'
       WHEN amount_inr BETWEEN 501 AND 2000 THEN 'Medium' WHEN amount_inr BETWEEN 2001 AND 10000 THEN 'Large' ELSE 'Very Large' END AS transaction_amount_category,
  fraud_flag * 0.6 + CASE WHEN amount_inr > 10000 THEN 0.15 ELSE 0 END
    + CASE WHEN hour_of_day BETWEEN 0 AND 5 THEN 0.1 ELSE 0 END
    + CASE WHEN transaction_status = 'FAILED' THEN 0.15 ELSE 0 END AS fraud_score,
  amount_inr > 5000 AS is_high_value, hour_of_day BETWEEN 0 AND 5 AS is_unusual_time
FROM payments_std
WHERE transaction_id IS NOT NULL AND transaction_timestamp IS NOT NULL AND amount_inr >= 0 AND amount_inr <= 100000
  AND transaction_status IN ('SUCCESS','FAILED')
"""

ETL_PERSON = (
    "age income rent loan_repayment groceries transport eating_out entertainment utilities healthcare education "
    "miscellaneous desired_savings disposable_income potential_savings_groceries potential_savings_transport "
    "potential_savings_eating_out potential_savings_entertainment income_normalized "
    "disposable_income_normalized occupation_encoded city_tier_encoded"
).split()
ETL_PAYMENT = (
    "transaction_id transaction_timestamp transaction_type merchant_category amount transaction_status "
    "age_category sender_state device_type network_type fraud_flag is_weekend amount_category time_of_day "
    "transaction_month amount_normalized"
).split()
OUTLIERS = ["income", "rent", "loan_repayment", "insurance", "groceries"]

# name: (what it needs, its text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "finance_once": ((), FINANCE_SQL.format(customer="customer")),
    "finance_raw": (
        ("finance_once",),
        f"SELECT * FROM finance_once UNION ALL SELECT * FROM finance_once WHERE {FINANCE_REPEATED}",
    ),
    "payments_once": ((), PAYMENTS_SQL.format(orders="orders")),
    "payments_raw": (
        ("payments_once",),
        f"SELECT * FROM payments_once UNION ALL SELECT * FROM payments_once WHERE {PAYMENTS_REPEATED}",
    ),
    "finance_std": (
        ("finance_raw",),
        f"""SELECT id AS person_id, {', '.join(map(_zero, ('income', 'age', 'dependents')))},
        lower(trim(occupation)) AS occupation, lower(trim(city_tier)) AS city_tier,
        {', '.join(map(_floor0, EXPENSES))},
        {', '.join(map(_zero, ('desired_savings_percentage', 'desired_savings', 'disposable_income', *POTENTIALS)))}
        FROM finance_raw WHERE id IS NOT NULL""",
    ),
    "finance_elt": (("finance_std",), _FINANCE_ELT),
    "payments_std": (
        ("payments_raw",),
        f"""SELECT lower(trim(transaction_id)) AS transaction_id, CAST("timestamp" AS TIMESTAMP) AS transaction_timestamp,
        {', '.join(f'lower(trim({c})) AS {c}' for c in _ELT_TEXT.split())}, {_floor0('amount_inr')},
        upper(trim(transaction_status)) AS transaction_status,
        lower(trim(regexp_replace(sender_age_group, ' ', '', 'g'))) AS sender_age_group,
        lower(trim(regexp_replace(receiver_age_group, ' ', '', 'g'))) AS receiver_age_group,
        {', '.join(map(_zero, ('fraud_flag', 'hour_of_day', 'is_weekend')))}
        FROM payments_raw WHERE transaction_id IS NOT NULL AND "timestamp" IS NOT NULL""",
    ),
    "payments_elt": (("payments_std",), _PAYMENTS_ELT),
    "pairs_elt": (
        ("finance_elt", "payments_elt"),
        """SELECT u.* EXCLUDE (amount_inr), u.amount_inr AS transaction_amount, f.*
        FROM payments_elt u LEFT JOIN finance_elt f ON u.sender_age_category = f.age_category
        WHERE u.transaction_status = 'SUCCESS' AND f.person_id IS NOT NULL""",
    ),
    "finance_typed": (
        ("finance_raw",),
        f"""SELECT TRY_CAST(CAST(id AS VARCHAR) AS VARCHAR) AS id,
        {', '.join(f'TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) AS {c}' for c in NUMERIC)}, age, dependents,
        lower(trim(coalesce(occupation, 'Unknown'))) AS occupation, lower(trim(coalesce(city_tier, 'Unknown'))) AS city_tier
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY income NULLS FIRST) AS rn FROM finance_raw) WHERE rn = 1""",
    ),
    "finance_medians": (
        ("finance_typed",),
        f"SELECT {', '.join(f'{quantile(c, 0.5)} AS {c}' for c in NUMERIC)} FROM finance_typed",
    ),
    "finance_filled": (
        ("finance_typed", "finance_medians"),
        f"""SELECT t.id, t.age, t.dependents, t.occupation, t.city_tier,
        {', '.join(f'coalesce(t.{c}, m.{c}) AS {c}' for c in NUMERIC)} FROM finance_typed t CROSS JOIN finance_medians m""",
    ),
    "finance_bounds": (
        ("finance_filled",),
        f"""SELECT {', '.join(f'{quantile(c, p)} AS {k}_{c}' for c in OUTLIERS for k, p in (('q1', 0.25), ('q3', 0.75)))},
        {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in ('income', 'disposable_income'))} FROM finance_filled""",
    ),
    "finance_etl": (
        ("finance_filled", "finance_bounds"),
        f"""SELECT d.*, {age_band('age', CATEGORIES)} AS age_category,
        CASE occupation WHEN 'self_employed' THEN 1 WHEN 'retired' THEN 2 WHEN 'student' THEN 3 WHEN 'professional' THEN 4 WHEN 'unknown' THEN 0 END AS occupation_encoded,
        CASE city_tier WHEN 'tier_1' THEN 1 WHEN 'tier_2' THEN 2 WHEN 'tier_3' THEN 3 WHEN 'unknown' THEN 0 END AS city_tier_encoded,
        {', '.join(f'coalesce({c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}), false) AS {c}_outlier_flag' for c in OUTLIERS)},
        {', '.join(f'({c} - lo_{c}) / nullif(hi_{c} - lo_{c}, 0) AS {c}_normalized' for c in ('income', 'disposable_income'))}
        FROM finance_filled d CROSS JOIN finance_bounds b""",
    ),
    "payments_typed": (
        ("payments_raw",),
        f"""SELECT transaction_id, TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
        {', '.join(_etl_text(c, d) for c, d in _ETL_FILL.items())}, TRY_CAST(CAST(amount_inr AS VARCHAR) AS DOUBLE) AS amount,
        fraud_flag, hour_of_day, is_weekend
        FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY amount_inr NULLS FIRST) AS rn FROM payments_raw) WHERE rn = 1""",
    ),
    "payments_prepared": (
        ("payments_typed",),
        f"""SELECT * EXCLUDE (amount), amount, {group_category('sender_age_group', False)} AS sender_age_category,
        CAST("timestamp" AS DATE) AS transaction_date, year("timestamp") AS transaction_year,
        month("timestamp") AS transaction_month, day("timestamp") AS transaction_day,
        CASE WHEN amount < 500 THEN 'Very Low' WHEN amount < 1000 THEN 'Low' WHEN amount < 2500 THEN 'Medium'
             WHEN amount < 5000 THEN 'High' WHEN amount >= 5000 THEN 'Very High' ELSE 'Unknown' END AS amount_category,
        is_weekend = 1 AS is_weekend_bool,
        CASE WHEN hour_of_day BETWEEN 0 AND 5 THEN 'Night' WHEN hour_of_day BETWEEN 6 AND 11 THEN 'Morning'
             WHEN hour_of_day BETWEEN 12 AND 17 THEN 'Afternoon' WHEN hour_of_day BETWEEN 18 AND 23 THEN 'Evening' ELSE 'Unknown' END AS time_of_day
        FROM (SELECT * EXCLUDE (amount), coalesce(amount, (SELECT {quantile('amount', 0.5)} FROM payments_typed)) AS amount FROM payments_typed)""",
    ),
    "payments_etl": (
        ("payments_prepared",),
        """SELECT p.*, (amount - lo) / nullif(hi - lo, 0) AS amount_normalized
        FROM (SELECT *, min(amount) OVER () AS lo, max(amount) OVER () AS hi FROM payments_prepared
              WHERE amount > 0 AND "timestamp" IS NOT NULL AND transaction_id IS NOT NULL) p""",
    ),
    "pairs_base": (
        ("finance_etl", "payments_etl"),
        f"""SELECT u.transaction_id, u."timestamp" AS transaction_timestamp, u.transaction_type, u.merchant_category, u.amount,
        u.transaction_status, u.sender_age_category AS age_category, u.sender_state, u.device_type, u.network_type, u.fraud_flag,
        u.is_weekend, u.amount_category, u.time_of_day, u.transaction_month, u.transaction_year, u.amount_normalized,
        f.id AS finance_id, f.occupation, f.city_tier, {', '.join(f'f.{c}' for c in ETL_PERSON)}
        FROM payments_etl u JOIN finance_etl f ON u.sender_age_category = f.age_category""",
    ),
    "pairs_etl": (
        ("pairs_base",),
        """SELECT *, 40 * disposable_income_normalized + 30 * (1 - spending_income_ratio) + 30 * income_normalized AS financial_health_score,
        CASE WHEN high_savings_category > 0 THEN high_savings_category / amount * 100 ELSE 0 END AS savings_opportunity_score
        FROM (SELECT *, CASE WHEN income > 0 THEN amount / income ELSE 0 END AS spending_income_ratio,
          CASE merchant_category WHEN 'groceries' THEN potential_savings_groceries WHEN 'transport' THEN potential_savings_transport
            WHEN 'food' THEN potential_savings_eating_out WHEN 'entertainment' THEN potential_savings_entertainment ELSE 0 END AS high_savings_category,
          coalesce(amount <= disposable_income * 0.1::DOUBLE, false) AS is_affordable_transaction,
          CASE WHEN is_weekend = 1 AND merchant_category IN ('food','entertainment','shopping') THEN amount * 1.2::DOUBLE ELSE amount END AS weekend_spending_impact,
          age_category || '_' || merchant_category AS age_transaction_pattern,
          CASE WHEN device_type IN ('android','ios') THEN 100.0 WHEN device_type = 'web' THEN 75.0 ELSE 50.0 END AS digital_adoption_score
          FROM pairs_base)""",
    ),
    "dim_age": (
        ("pairs_base",),
        f"""SELECT CAST(row_number() OVER (ORDER BY age_category) AS INT) AS age_category_id, age_category,
        CASE age_category {' '.join(f"WHEN '{k}' THEN '{r}'" for r, k in zip(RANGES, CATEGORIES))} ELSE 'Unknown' END AS age_range
        FROM (SELECT DISTINCT age_category FROM pairs_base)""",
    ),
    "dim_merchant": (
        ("pairs_base",),
        f"""SELECT CAST('0x' || substr(md5({key_part('merchant_category')}), 1, 15) AS BIGINT) AS merchant_category_id,
        merchant_category AS category_name FROM (SELECT DISTINCT merchant_category FROM pairs_base)""",
    ),
    "dim_place": (
        ("pairs_base",),
        f"""SELECT CAST('0x' || substr(md5({key_part('sender_state')} || {key_part('city_tier')}), 1, 15) AS BIGINT) AS location_id,
        sender_state AS state, city_tier, 'India' AS region FROM (SELECT DISTINCT sender_state, city_tier FROM pairs_base)""",
    ),
    "dim_occ": (
        ("pairs_base",),
        """SELECT DISTINCT occupation_encoded AS occupation_id, occupation AS occupation_name FROM pairs_base""",
    ),
    "dim_day": (
        ("pairs_base",),
        """SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_id, full_date, year(full_date) AS "year", month(full_date) AS "month",
        day(full_date) AS "day", quarter(full_date) AS "quarter", dayname(full_date) AS day_of_week,
        dayofweek(full_date) IN (0, 6) AS is_weekend, monthname(full_date) AS month_name
        FROM (SELECT DISTINCT CAST(transaction_timestamp AS DATE) AS full_date FROM pairs_base)""",
    ),
    "fact": (
        ("pairs_etl", "dim_age", "dim_merchant", "dim_place"),
        """SELECT p.*, CAST(strftime(transaction_timestamp, '%Y%m%d') AS INT) AS date_id, a.age_category_id,
        p.occupation_encoded AS occupation_id, m.merchant_category_id, l.location_id
        FROM pairs_etl p LEFT JOIN dim_age a ON p.age_category = a.age_category
        LEFT JOIN dim_merchant m ON p.merchant_category = m.category_name
        LEFT JOIN dim_place l ON p.sender_state = l.state AND p.city_tier = l.city_tier""",
    ),
}


def build(select: str, *needs: str) -> str:
    """``WITH`` the named expressions and all they need, then ``select``."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in CTES[name][0]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + select
