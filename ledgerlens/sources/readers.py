"""Sources. Kafka and JDBC need their connector on the class path; files and any
other (key, value, timestamp) source go through the same ``format`` argument."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.keys import row_numbers

METADATA = ("_extracted_at", "_source")
# whole numbers of the typed landing; everything else numeric is a double
_WHOLE = ("id", "age", "dependents", "fraud_flag", "hour_of_day", "is_weekend")


def _schema(columns, kinds: Mapping[str, str], extra=()) -> T.StructType:
    out = T.StructType()
    for n in columns:
        out = out.add(n, kinds.get(n, "string"))
    for n in extra:
        out = out.add(n, "string")
    return out


_FINANCE_KINDS = {n: "double" for n in rules.FINANCE_NUMERIC} | {n: "integer" for n in _WHOLE} | {"id": "long"}
_PAYMENT_KINDS = {"amount_inr": "double"} | {n: "integer" for n in _WHOLE}
FINANCE_TYPED = _schema(rules.FINANCE_COLUMNS, _FINANCE_KINDS, METADATA)
PAYMENTS_TYPED = _schema(rules.PAYMENT_COLUMNS, _PAYMENT_KINDS, METADATA)
# the all-text landing, with the raw amount name
FINANCE_TEXT = _schema(rules.FINANCE_COLUMNS + ("created_at", "updated_at"), {}, ("_extract_timestamp", "_source"))
PAYMENTS_TEXT = _schema(
    [n if n != "amount_inr" else "amount_(inr)" for n in rules.PAYMENT_COLUMNS], {},
    ("_extract_timestamp", "_source", "_record_number"),
)
# what the two streams read of each record
FINANCE_STREAM = _schema(("id", "income", "age", "occupation"), _FINANCE_KINDS)
PAYMENTS_STREAM = _schema(
    ("transaction_id", "timestamp", "amount_inr", "transaction_status", "sender_age_group"), _PAYMENT_KINDS
)
RECORD = T.StructType().add("key", "binary").add("value", "binary").add("timestamp", "timestamp")


def kafka_options(servers: str, topic: str, starting: str = "earliest", stream: bool = False) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    return options | {"failOnDataLoss": "false"} if stream else options


def read_topic(
    spark: SparkSession, options: Mapping[str, str], source: str = "kafka", path: str | None = None,
    stream: bool = False,
) -> DataFrame:
    """A topic, bounded or as a stream, with at least ``value`` and ``timestamp``.

    Any file format of key/value/timestamp records may stand in for Kafka; it then needs ``path``.
    """
    reader = (spark.readStream if stream else spark.read).format(source).options(**options)
    if source != "kafka":
        reader = reader.schema(RECORD)
    return reader.load(path) if path else reader.load()


def parse_records(records: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON in ``value`` to columns. A malformed record gives a row of NULLs."""
    return records.select(F.from_json(F.col("value").cast("string"), schema).alias("data"), *keep).select("data.*", *keep)


def malformed_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: how many records are no JSON object of the schema."""
    corrupt = T.StructType(list(schema.fields)).add("_corrupt", "string")
    parsed = F.from_json(F.col("value").cast("string"), corrupt, {"columnNameOfCorruptRecord": "_corrupt"})
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(F.col("value").isNotNull() & (parsed["_corrupt"].isNotNull()), 1)).alias("malformed"),
    )


#: Why a record is kept apart.
EMPTY, MALFORMED, NO_KEY = "empty value", "malformed", "no key"


def judged_records(records: DataFrame, schema: T.StructType, required: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Records with their columns and ``_reason``, NULL for good ones; ``_raw`` holds the value of the others.

    One parse tells all: an empty value, text that is no JSON object of the schema, or one
    that lacks a ``required`` field.
    """
    corrupt = T.StructType(list(schema.fields)).add("_corrupt", "string")
    options = {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    text = F.col("value").cast("string")
    rows = records.select(text.alias("_text"), F.from_json(text, corrupt, options).alias("data"), *keep)
    lacking = F.lit(False)
    for n in required:
        lacking = lacking | F.col(f"data.{n}").isNull()
    reason = (F.when(F.coalesce(F.trim("_text"), F.lit("")) == "", EMPTY)
              .when(F.col("data").isNull() | F.col("data._corrupt").isNotNull(), MALFORMED).when(lacking, NO_KEY))
    rows = rows.withColumn("_reason", reason)
    return rows.select(*[F.col(f"data.{f.name}").alias(f.name) for f in schema.fields], *keep, "_reason",
                       F.when(F.col("_reason").isNotNull(), F.col("_text")).alias("_raw"))


def split_records(judged: DataFrame, path: str, mode: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good rows and the quarantine (with ``_reason`` and ``_raw``), written by one pass into two partitions of ``path``.

    Reading one of them does not touch the other's files.
    """
    spark = judged.sparkSession
    judged.withColumn("_state", F.when(F.col("_reason").isNull(), "good").otherwise("quarantine")).write.mode(mode).partitionBy("_state").parquet(path)
    rows = spark.read.schema(judged.schema.add("_state", "string")).parquet(path)
    good = rows.where("_state = 'good'").drop("_state", "_reason", "_raw")
    return good, rows.where("_state = 'quarantine'").drop("_state")


def with_extract_metadata(df: DataFrame, source_system: str, as_of: Column | None = None) -> DataFrame:
    """Extraction time and source label; ``as_of`` fixes the time for reproducible runs."""
    return df.withColumns({
        "extract_date": F.current_timestamp() if as_of is None else as_of,
        "source_system": F.lit(source_system),
    })


def staging_names(df: DataFrame, processed_at: Column) -> DataFrame:
    """Record metadata under the names the staging tables use."""
    return df.withColumnsRenamed({"_extracted_at": "extracted_at", "_source": "source_system"}).withColumn(
        "processed_at", processed_at
    )


def read_csv(spark: SparkSession, path: str, columns) -> DataFrame:
    """CSV with a header, all text: no inference pass and no lost digits."""
    return spark.read.schema(_schema(columns, {})).csv(path, header=True)


def read_finance_seed(spark: SparkSession, path: str) -> DataFrame:
    """The seed CSV without ids, typed. Ids are 1..n in an order the content decides."""
    names = [n for n in rules.FINANCE_COLUMNS if n != "id"]
    text = read_csv(spark, path, names)
    typed = text.select(*[F.col(n).try_cast(_seed_kind(n)).alias(n) for n in names])
    return row_numbers(typed, "id", names).select("id", *names)


def _seed_kind(name: str) -> str:
    if name in _WHOLE:
        return "bigint" if name == "id" else "int"
    if name == "desired_savings_percentage":
        return "decimal(5,2)"
    return "decimal(12,2)" if name in rules.FINANCE_NUMERIC else "string"


def normalise_payment_csv(text: DataFrame, source: str = "csv_file", as_of: Column | None = None) -> DataFrame:
    """CSV rows to typed records: trimmed text with '' for missing, numbers with 0 for missing."""
    numbers = {"amount_inr": "double", "fraud_flag": "int", "hour_of_day": "int", "is_weekend": "int"}
    return text.select(*[
        F.coalesce(F.trim(n).try_cast(numbers[n]), F.lit(0).cast(numbers[n])).alias(n) if n in numbers
        else F.coalesce(F.trim(n), F.lit("")).alias(n)
        for n in rules.PAYMENT_COLUMNS
    ], (F.current_timestamp() if as_of is None else as_of).cast("string").alias("_extracted_at"),
        F.lit(source).alias("_source"))


def numbered(records: DataFrame, key: str) -> DataFrame:
    """``_record_number`` 1..n, the same on every run over the same rows."""
    return row_numbers(records, "_record_number", (key,))


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table in parallel id ranges. The bounds only set the strides: no row is left out."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=dict(properties or {}),
    )


def to_json_records(df: DataFrame, key: str, source: str, as_of: Column | None = None) -> DataFrame:
    """Rows as (key, value) records, the value JSON with NULLs kept and metadata added."""
    body = df.withColumns({
        "_extracted_at": (F.current_timestamp() if as_of is None else as_of).cast("string"), "_source": F.lit(source),
    })
    return body.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*body.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def age_group_mapping(spark: SparkSession) -> DataFrame:
    """The five-row view age_range -> age_category."""
    rows = " UNION ALL ".join(f"SELECT '{r}' AS age_range, '{cat}' AS age_category" for _, _, r, cat in rules.AGE_BANDS)
    return spark.sql(rows)
