"""The two inputs derived from the test tables (see FIXTURES.md).

Labels come from literal arrays by position rather than from long CASE chains, which
keeps the generated code of scan, adapter and cleaning small enough to be compiled.
Every 50th key is repeated by a generator within the one scan.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules

# Labels by remainder of a key; None is a NULL label.
TYPES = ("P2P", " P2M", "Bill Payment", "Recharge")
MERCHANTS = (
    "Food", "Grocery", "Eating_Out", "Entertainment", "Shopping ", "Fuel", "Transport", "Healthcare",
    "Insurance", "Education", "Utilities", "Recharge", None,
)
SENDER_GROUPS = ("18-25", "26 - 35", "36-45 ", "46-55", "56+", None)
RECEIVER_GROUPS = ("18-25", "26-35", "36-45", "46-55", "56+")
DEVICES = ("iOS", "Web", None) + ("Android",) * 7
NETWORKS = ("5G", "WiFi", "3G") + ("4G",) * 6
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
SEGMENTS = ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD")
OCCUPATIONS = (" Self_Employed ", "Professional", "RETIRED", "student")
# Fixed values: (column, offset, step, modulus) for offset + key * step % modulus.
FINANCE_STEPS = (
    ("insurance", 200, 43, 2000), ("groceries", 800, 47, 7000), ("transport", 300, 53, 3000),
    ("eating_out", 100, 59, 2000), ("entertainment", 100, 61, 1800), ("utilities", 400, 67, 3000),
    ("healthcare", 100, 71, 1600), ("miscellaneous", 0, 79, 900),
    ("potential_savings_groceries", 0, 7, 1700), ("potential_savings_transport", 0, 11, 400),
    ("potential_savings_eating_out", 0, 13, 500), ("potential_savings_entertainment", 0, 17, 300),
    ("potential_savings_utilities", 0, 19, 700), ("potential_savings_healthcare", 0, 23, 100),
    ("potential_savings_education", 0, 29, 60), ("potential_savings_miscellaneous", 0, 31, 100),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _label(key: Column, labels: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (key % len(labels) + 1).cast("int"))


def _money(c: Column) -> Column:
    return c.cast("decimal(12,2)")


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def _with_repeats(df: DataFrame, key: Column) -> DataFrame:
    copies = F.when(_every(key, 50), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(copies).alias("_copy"))


def finance_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as household profiles, every 50th twice."""
    k, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    rows = _with_repeats(table(spark, sf_dir, "customer"), k)
    income = (F.round(F.col("c_acctbal") * 100).cast("bigint") + 100000) * 12

    def steps(offset: int, step: int, modulus: int) -> Column:
        return offset + k * step % modulus

    made = {
        "id": k.cast("bigint"),
        "income": F.when(~_every(k, 97), _money(income / F.lit(100.0))),
        "age": F.when(~_every(k, 89), (16 + k % 49).cast("int")),
        "dependents": (k % 5).cast("int"),
        "occupation": F.get(F.array(*map(F.lit, OCCUPATIONS)), F.array_position(F.array(*map(F.lit, SEGMENTS)), segment).cast("int") - 1),
        "city_tier": F.when(nation != 24, F.concat(F.lit("Tier_"), (1 + nation % 3).cast("string"))),
        "rent": _money(F.when(_every(k, 53), -1).otherwise(1) * steps(1000, 37, 20000)),
        "loan_repayment": _money(F.when(_every(k, 3), 0).otherwise(steps(500, 41, 6000))),
        "education": _money(F.when(_every(k, 4), 0).otherwise(steps(0, 73, 2500))),
        "desired_savings_percentage": (5 + k % 20).cast("decimal(5,2)"),
        "desired_savings": _money(F.when(_every(k, 31), 0).otherwise(steps(500, 83, 9000))),
        "disposable_income": _money(income / F.lit(400.0) - 3000),
    } | {name: _money(steps(*numbers)) for name, *numbers in FINANCE_STEPS}
    return rows.select(*[made[n].alias(n) for n in rules.FINANCE_COLUMNS])


def payments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments, every 50th twice."""
    k, customer, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    rows = _with_repeats(table(spark, sf_dir, "orders"), k)
    cents = F.round(price * 100).cast("bigint") % F.when(_every(k, 2), 60000).otherwise(1200000)
    amount = (
        F.when(_every(k, 173), F.lit(None)).when(_every(k, 179), _money(F.lit(-50)))
        .when(_every(k, 101), _money(price)).otherwise(_money(cents / F.lit(100.0)))
    )
    hour = F.lpad((k % 24).cast("string"), 2, "0")
    made = {
        "transaction_id": F.concat(F.lit("TXN"), F.lpad(k.cast("string"), F.greatest(F.lit(9), F.length(k.cast("string"))), F.lit("0"))),
        "timestamp": F.when(~_every(k, 307), F.concat(
            F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit(" "), hour, F.lit(":15:00"))),
        "transaction_type": _label(k, TYPES), "merchant_category": _label(k, MERCHANTS), "amount_inr": amount,
        "transaction_status": F.when(_every(k, 211), "PENDING").when(F.col("o_orderstatus") == "P", " failed").otherwise("Success"),
        "sender_age_group": _label(customer, SENDER_GROUPS), "receiver_age_group": _label(k, RECEIVER_GROUPS),
        "sender_state": F.concat(F.lit("State "), (customer % 25).cast("string")),
        "sender_bank": F.concat(F.lit("Bank "), (customer % 7).cast("string")),
        "receiver_bank": F.concat(F.lit("Bank "), (k % 7).cast("string")),
        "device_type": _label(k, DEVICES), "network_type": _label(k, NETWORKS),
        "fraud_flag": _every(k, 200).cast("int"), "hour_of_day": (k % 24).cast("int"),
        "day_of_week": _label(k, DAYS), "is_weekend": (k % 7 >= 5).cast("int"),
    }
    return rows.select(*[made[n].alias(n) for n in rules.PAYMENT_COLUMNS])


def as_text(df: DataFrame) -> DataFrame:
    """The all-text landing of the etl profile, with its raw amount column name."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return text.withColumnRenamed("amount_inr", "amount_(inr)")
