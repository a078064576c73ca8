"""

Every query starts from the given tables (through ``ledgerlens.sources.testdata``)
and runs over all of their rows. ``portable`` only prepares a result for the
comparison: decimals become doubles, doubles are rounded, times become text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import rules
from ledgerlens.functions.exact import half_up
from ledgerlens.functions.onerow import beside
from ledgerlens.operators import cleaning, finance, payments, quality
from ledgerlens.plans import checks, elt, etl, facts, incremental, pipeline, quality_run, star, warehouse
from ledgerlens.sources import readers, testdata, versioned, workspace, writers
from ledgerlens.streaming import jobs

try:  # the training-data operators are one optional part; without them the rest works
    import corpus_pipeline
    from ledgerlens.llm.oracle import ORACLE
    from ledgerlens.llm.queries import QUERIES

    _LLM_QUERIES, _LLM_ORACLE = QUERIES | {"pipeline": corpus_pipeline.run}, dict(ORACLE)
    if corpus_pipeline.ORACLE_SQL:
        _LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "ledgerlens.llm", "ledgerlens.llm.oracle", "ledgerlens.llm.queries"):
        raise
    _LLM_QUERIES, _LLM_ORACLE = {}, {}

c = F.col
Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame, digits: dict[str, int] | None = None, default: int = 4) -> DataFrame:
    out = []
    for f in df.schema.fields:
        x, kind = c(f"`{f.name}`"), f.dataType
        if isinstance(kind, T.DecimalType) and kind.scale == 0:
            x = x.try_cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
            x = half_up(x, (digits or {}).get(f.name, default)).cast("double")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            x = x.cast("string")
        out.append(x.alias(f.name))
    return df.select(*out)


# ---- inputs at each stage -------------------------------------------------------------------

def _finance(spark, d):
    return testdata.finance_raw(spark, d)


def _payments(spark, d):
    return testdata.payments_raw(spark, d)


def _finance_elt(spark, d):
    return finance.clean_elt(_finance(spark, d))


def _payments_elt(spark, d):
    return payments.clean_elt(_payments(spark, d))


def _pairs_elt(spark, d):
    return elt.joined(_payments_elt(spark, d), _finance_elt(spark, d))


def _finance_etl(spark, d):
    return finance.clean_etl(testdata.as_text(_finance(spark, d)))


def _prepared_etl(spark, d):
    return payments.prepared_etl(testdata.as_text(_payments(spark, d)))


def _pairs_etl(spark, d):
    """Both cleaned sets, written to the shared folder and read back as the etl run does."""
    return pipeline.stage_etl(
        testdata.as_text(_finance(spark, d)), testdata.as_text(_payments(spark, d)),
        workspace.new_path(spark, "etl"), rejected=False,
    )


def _warehouse(spark, d):
    return pipeline.staged_warehouse(_pairs_etl(spark, d), workspace.new_path(spark, "dw"))


def _from(stage: Callable, make: Callable, digits: dict[str, int] | None = None, default: int = 4) -> Query:
    """A query that builds its result from one stage."""
    return lambda spark, d: portable(make(stage(spark, d)), digits, default)


# ---- sources and sinks ----------------------------------------------------------------------

def src_parquet(spark, d):
    orders = testdata.table(spark, d, "orders")
    return portable(orders.where(c("o_orderstatus") == "P").select("o_orderkey", "o_custkey", "o_totalprice"))


def src_json_parse(spark, d):
    events = testdata.table(spark, d, "events").select(
        c("props").alias("value"), "event_id", "event_type"
    )
    return readers.parse_records(events, T.StructType().add("k", "integer"), ("event_id", "event_type"))


def src_csv_normalise(spark, d):
    path = workspace.new_path(spark, "payments-csv")
    text = _payments(spark, d).select(*[c(n).cast("string").alias(n) for n in rules.PAYMENT_COLUMNS])
    text.write.option("header", True).csv(path)
    rows = readers.normalise_payment_csv(readers.read_csv(spark, path, rules.PAYMENT_COLUMNS))
    return portable(readers.numbered(rows.drop("_extracted_at"), "transaction_id"))


def src_jdbc_to_json(spark, d):
    records = readers.to_json_records(_finance(spark, d), "id", "postgres")
    parsed = readers.parse_records(records, readers.FINANCE_TYPED, ("key",))
    return portable(parsed.select("key", *rules.FINANCE_COLUMNS, "_source"))


def src_mapping_view(spark, d):
    groups = _payments(spark, d).select(cleaning.strip_inner_spaces(c("sender_age_group")).alias("age_range"))
    mapping = readers.age_group_mapping(spark)  # five rows
    return groups.join(F.broadcast(mapping), "age_range").groupBy("age_range", "age_category").agg(
        F.count(F.lit(1)).alias("payments")
    )


def snk_partitioned_raw(spark, d):
    path = workspace.new_path(spark, "raw-payments")
    writers.land_raw_payments(_payments(spark, d), path)
    landed = spark.read.option("recursiveFileLookup", "false").parquet(path)
    return portable(landed.groupBy("year", "month", "status").agg(
        F.count(F.lit(1)).alias("records"), F.sum("amount_inr").alias("total_amount")
    ).withColumns({"year": c("year").cast("int"), "month": c("month").cast("int")}))


def snk_audit_log(spark, d):
    raw = _finance(spark, d)
    audit = writers.audit_rows(raw, "finance", "INITIAL_LOAD")
    return portable(beside(audit, writers.load_check(raw, "finance").drop("table_name")))


# ---- cleaning steps -------------------------------------------------------------------------

def cast_numeric_safe(spark, d):
    raw = _payments(spark, d).select(
        "transaction_id",
        F.when(c("fraud_flag") == 1, F.lit("n/a")).otherwise(c("amount_inr").cast("string")).alias("amount"),
        F.when(c("hour_of_day") == 3, F.lit("")).otherwise(c("hour_of_day").cast("string")).alias("hour"),
    )
    return portable(cleaning.cast_numeric_safe(raw, {"amount": "double", "hour": "int"}))


def parse_timestamp(spark, d):
    raw = _payments(spark, d)
    odd = F.when(c("hour_of_day") == 5, F.concat(F.substring("timestamp", 1, 5), F.lit("13-01 00:00:00")))
    text = F.coalesce(odd, c("timestamp"))
    return portable(raw.select("transaction_id", cleaning.parse_timestamp(text).alias("parsed")))


def standardize_text(spark, d):
    names = ("merchant_category", "transaction_type", "transaction_status")
    out = cleaning.standardize_text(_payments(spark, d).select("transaction_id", *names), names)
    return out.withColumn("status_upper", F.upper("transaction_status"))


def strip_inner_spaces(spark, d):
    return _payments(spark, d).select(
        "transaction_id", *[
            cleaning.strip_inner_spaces(c(n)).alias(n) for n in ("sender_age_group", "receiver_age_group")
        ],
    )


def clamp_non_negative(spark, d):
    people = _finance(spark, d).select("id", *[cleaning.clamp_non_negative(n).alias(n) for n in rules.EXPENSES])
    return portable(people)


def fill_constant(spark, d):
    names = list(rules.PAYMENT_TEXT_DEFAULTS)
    return cleaning.fill_constant(_payments(spark, d).select("transaction_id", *names), rules.PAYMENT_TEXT_DEFAULTS)


def impute_median(spark, d):
    base = finance.standardize_etl(testdata.as_text(_finance(spark, d)))
    return portable(cleaning.impute_median(base, rules.FINANCE_NUMERIC).select("id", *rules.FINANCE_NUMERIC))


def dedup_by_key(spark, d):
    return portable(cleaning.dedup_by_key(_payments(spark, d), "transaction_id"))


def dedup_removed(spark, d):
    return cleaning.duplicates_removed(_payments(spark, d), "transaction_id")


def dedup_full_row(spark, d):
    return portable(_finance(spark, d).distinct())


def except_rejected(spark, d):
    prepared = _prepared_etl(spark, d).drop("amount_normalized")
    return portable(cleaning.except_rows(prepared, payments.accepted_etl(prepared)))


def anti_join_orphans(spark, d):
    base = payments.standardize_etl(testdata.as_text(_payments(spark, d)))
    return quality.orphans(base, "receiver_age_group", base, "sender_age_group")


def distinct_values(spark, d):
    return _pairs_etl(spark, d).matched_payments().select("merchant_category", "device_type").distinct()


def union_all_mapping(spark, d):
    """Both age columns of the payments as one relation, mapped to categories."""
    raw = _payments(spark, d)
    both = raw.select(c("sender_age_group").alias("g")).unionByName(raw.select(c("receiver_age_group").alias("g")))
    counted = both.groupBy(cleaning.strip_inner_spaces(c("g")).alias("age_range")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(F.broadcast(readers.age_group_mapping(spark)), "age_range")  # five rows


def sample_limit(spark, d):
    """A preview: the first five profiles by id."""
    return portable(_finance(spark, d).distinct().orderBy("id").limit(5))


def order_by_group(spark, d):
    return portable(checks.finance_distribution(_finance_elt(spark, d)))


def union_all_mart_counts(spark, d):
    pairs = _pairs_elt(spark, d)
    return elt.mart_counts({n: make(pairs) for n, make in elt.MARTS.items()})


def global_checks(spark, d):
    people, sends = _finance_elt(spark, d), _payments_elt(spark, d)
    return portable(
        checks.finance_checks(people).unionByName(checks.payment_checks(sends))
        .unionByName(checks.join_checks(elt.joined(sends, people)))
    )


# ---- quality --------------------------------------------------------------------------------

def dq_uniqueness(spark, d):
    pairs = _pairs_etl(spark, d)
    before = quality.check_uniqueness(pairs.payments, ("transaction_id", "sender_state")).withColumn("stage", F.lit("payments"))
    after = quality_run.uniqueness_checks(pairs).withColumn("stage", F.lit("joined"))
    return portable(before.unionByName(after))


def _null_checks(pairs):
    return quality_run.null_checks(pairs, *etl.CHECKED_COLUMNS)


def dq_nulls_raw(spark, d):
    return portable(quality.check_nulls(_payments(spark, d)))


def dq_referential(spark, d):
    w = _warehouse(spark, d)
    keys = (
        (w.fact_payments, "merchant_category_id", w.dim_merchant_category, "merchant_category_id"),
        (w.fact_payments, "age_category_id", w.dim_age_category, "age_category_id"),
        (w.fact_payments, "date_id", w.dim_date, "date_id"),
        (w.fact_persons, "occupation_id", w.dim_occupation, "occupation_id"),
    )
    out = [quality.check_referential(*k) for k in keys]
    base = payments.standardize_etl(testdata.as_text(_payments(spark, d)))
    out.append(quality.check_referential(base, "receiver_age_group", base, "sender_age_group"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def dq_report(spark, d):
    rows = quality_run.all_check_rows(spark, _pairs_etl(spark, d), *etl.CHECKED_COLUMNS)
    return portable(quality.quality_report(rows))


# ---- elt star schema ------------------------------------------------------------------------

def star_fact_personal_finance(spark, d):
    people = _finance_elt(spark, d)
    facts = star.fact_personal_finance(people, star.dim_age_group(people), F.lit("2024-01-31"))
    return portable(facts)


def star_fact_upi_transaction(spark, d):
    people, sends = _finance_elt(spark, d), _payments_elt(spark, d)
    return portable(star.fact_upi_transaction(
        sends, star.dim_transaction_type(sends), star.dim_merchant_category(sends), star.dim_age_group(people),
        star.dim_location(sends),
    ))


def scd1_upsert_person(spark, d):
    """Every third person moved up an age since: their new version replaces the old one."""
    people = _finance_elt(spark, d).select("person_id", "age", "occupation", "city_tier")
    before = people.withColumn("updated_at", F.lit("2024-01-01").cast("date"))
    changes = people.where(c("person_id") % 3 == 0).withColumns(
        {"age": c("age") + 1, "updated_at": F.lit("2024-02-01").cast("date")}
    )
    return portable(star.scd1_upsert(before, changes, "person_id", "updated_at"))


# ---- bucketed facts, upserts, loads ------------------------------------------------------------

def _star_tables(spark, d) -> str:
    """Cleaned inputs as bucketed tables in a database of their own in the shared folder."""
    place = workspace.new_path(spark, "bucketed")
    name = "star_" + place.rsplit("-", 1)[1]
    return facts.write_star(spark, _finance_elt(spark, d), _payments_elt(spark, d), name, place, F.lit("2024-01-31").cast("date"))


def bucket_join_persons(spark, d):
    """Finance facts and persons, merged bucket by bucket whatever their size."""
    return portable(facts.finance_by_person(spark, _star_tables(spark, d), small_bytes=-1))


def bucket_join_payments(spark, d):
    """Payment facts and clean payments, merged bucket by bucket whatever their size."""
    return portable(facts.payments_by_group(spark, _star_tables(spark, d), small_bytes=-1))


def map_join_by_size(spark, d):
    """The same join of persons, broadcast if the catalog says that one side is small."""
    return portable(facts.finance_by_person(spark, _star_tables(spark, d)))


def upsert_touched_buckets(spark, d):
    """Persons, then a load of the retired a year older and under a new tier: only the buckets of their keys are written."""
    people = _finance_elt(spark, d).select("person_id", "age", "occupation", "city_tier").withColumn("updated_at", F.lit("2024-01-01").cast("date"))
    table = versioned.VersionedTable(spark, workspace.new_path(spark, "dim-person"), key="person_id", buckets=64)
    table.upsert(people, ["updated_at"], "2024-01")
    retired = table.read().where("occupation = 'retired'").withColumns(
        {"age": c("age") + 1, "city_tier": F.lit("tier_9"), "updated_at": F.lit("2024-02-01").cast("date")})
    for _ in range(2):  # the second time the load is known
        table.upsert(retired, ["updated_at"], "2024-02")
    return portable(table.read())


def append_fact_once(spark, d):
    """Payments appended load by load, each year one load, and every load tried twice; then summed per month and status."""
    facts_, table = _payments_elt(spark, d).select("transaction_id", "amount_inr", "transaction_status", "transaction_year", "transaction_month"), None
    staged = workspace.new_path(spark, "fact-loads")
    writers.write_partitioned(facts_, staged, ("transaction_year",))
    rows = spark.read.parquet(staged)
    table = versioned.VersionedTable(spark, workspace.new_path(spark, "fact-payments"), partition_by=("transaction_year", "transaction_month"))
    years = sorted(r[0] for r in rows.select("transaction_year").distinct().collect())
    for year in years:
        for _ in range(2):
            table.append_once(rows.where(c("transaction_year") == year), f"year {year}")
    return portable(table.read().groupBy("transaction_year", "transaction_month", "transaction_status").agg(
        F.count(F.lit(1)).alias("payments"), F.countDistinct("transaction_id").alias("ids"), F.sum("amount_inr").alias("total_amount")))


def scd1_changed_only(spark, d):
    """Two full deliveries of the persons, the second with some moved up an age: only those are written; with the rows each load wrote."""
    people = _finance_elt(spark, d).select("person_id", "age", "occupation", "city_tier")
    table = versioned.VersionedTable(spark, workspace.new_path(spark, "dim-person"), key="person_id", buckets=16)
    pipeline.load_persons(table, people, "first")
    second = people.withColumn("age", F.when(c("city_tier") == "tier_2", c("age") + 1).otherwise(c("age")))
    changed = pipeline.load_persons(table, second, "second")
    again = pipeline.load_persons(table, second, "third")
    return portable(table.read().withColumns({"rows_changed": F.lit(changed).cast("long"), "rows_changed_again": F.lit(again).cast("long")}))


def behavior_agg_incremental(spark, d):
    """The spending-behaviour fact after two loads: payments by web come later, and only their months are made anew."""
    pairs = _pairs_elt(spark, d)
    names = [*incremental.BY, "transaction_amount", "fraud_flag", "is_weekend", "device_type"]
    rows = pairs.payments.select(*names)
    stored, states = workspace.new_path(spark, "payments-by-month"), workspace.new_path(spark, "states")
    late = F.coalesce((c("device_type") == "web") & (c("transaction_year") >= 1997), F.lit(False))
    for part in (rows.where(~late), rows.where(late)):
        incremental.load(spark, part, stored, states)
    return portable(incremental.behavior_from_states(spark.read.parquet(states), pairs))


def src_json_quarantine(spark, d):
    """Payment records, some cut off and some without an id, split in one pass; counted with their amounts."""
    records = readers.to_json_records(_payments(spark, d), "transaction_id", "table")
    hour = F.get_json_object("value", "$.hour_of_day").cast("int")
    broken = F.when(hour == 3, F.expr("left(value, 40)")).when(hour == 5, F.lit(" ")).when(
        hour == 7, F.regexp_replace("value", '"transaction_id":"[^"]*"', '"transaction_id":null')).otherwise(c("value"))
    judged = readers.judged_records(records.withColumn("value", broken), readers.PAYMENTS_TYPED, ("transaction_id",))
    good, bad = readers.split_records(judged, workspace.new_path(spark, "split"))
    counted = good.agg(F.count(F.lit(1)).alias("records"), F.sum(c("amount_inr").cast("decimal(18,2)")).alias("total_amount")).withColumn("reason", F.lit("good"))
    return portable(counted.select("reason", "records", "total_amount").unionByName(
        bad.groupBy(c("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("records")).withColumn("total_amount", F.lit(None).cast("decimal(18,2)"))))


def audit_of_loads(spark, d):
    """The audit log of a load of both clean sets and of one that fails: counted while written."""
    log, base = workspace.new_path(spark, "audit"), workspace.new_path(spark, "audited")
    writers.audited(_finance_elt(spark, d), lambda df: df.write.parquet(f"{base}/finance"), "clean_india_personal_finance", "INITIAL_LOAD", log)
    writers.audited(_payments_elt(spark, d), lambda df: df.write.parquet(f"{base}/payments"), "clean_upi_transaction", "INITIAL_LOAD", log)
    try:  # the folder is taken
        writers.audited(_finance_elt(spark, d), lambda df: df.write.parquet(f"{base}/payments"), "clean_india_personal_finance", "RELOAD", log)
    except Exception as error:
        if "PATH_ALREADY_EXISTS" not in str(error):
            raise
    return portable(spark.read.parquet(log).select("table_name", "operation", "record_count", "status", c("error_message").isNotNull().alias("failed")))


def cat_column_stats(spark, d):
    """Statistics of the columns of the clean payments, as the planner has them; estimates of distinct values as a check of their error."""
    place = workspace.new_path(spark, "stats")
    name = "stats_" + place.rsplit("-", 1)[1]
    writers.create_database(spark, name, "Statistics", place)
    table = _payments_elt(spark, d).select("transaction_id", "amount_inr", "hour_of_day", "is_weekend", "fraud_flag", "transaction_year", "transaction_month")
    writers.save_table(table, f"{name}.clean_payments", "overwrite")
    found = writers.column_statistics(spark, [f"{name}.clean_payments"])
    exact = spark.table(f"{name}.clean_payments").agg(*[F.countDistinct(n).alias(n) for n in table.columns]).first()
    near = F.lit(False)
    for n in table.columns:
        near = F.when(c("column_name") == n, F.abs(c("distinct_estimate") - F.lit(exact[n])) <= F.lit(exact[n]) * 0.15).otherwise(near)
    return found.select("table_name", "column_name", "row_count", "null_count", c("min_value").try_cast("double").alias("low"),
                        c("max_value").try_cast("double").alias("high"), near.alias("distinct_within_15_percent"), "histogram")


def dq_distribution_sketch(spark, d):
    """Quantiles of amount from sketches kept per month and merged; whether their true ranks are within the stated error."""
    rows = _payments_elt(spark, d).select("amount_inr", "hour_of_day", "transaction_year", "transaction_month").withColumn("amount", c("amount_inr").cast("double"))
    kept = workspace.new_path(spark, "sketches")
    quality.distribution_sketches(rows, ("amount", "hour_of_day"), ("transaction_year", "transaction_month")).write.parquet(kept)
    found = quality.sketched_quantiles(spark.read.parquet(kept))
    values = rows.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column"), c(n).cast("double").alias("value")) for n in ("amount", "hour_of_day")])).alias("v")).select("v.*")
    ranks = values.join(F.broadcast(found), "column").groupBy("column", "prob", "count", "quantile").agg(  # six rows
        F.avg((c("value") < c("quantile")).cast("double")).alias("below"), F.avg((c("value") <= c("quantile")).cast("double")).alias("upto"))
    error = quality.RANK_ERROR
    return ranks.select("column", "count", "prob", ((c("below") - error <= c("prob")) & (c("prob") <= c("upto") + error)).alias("close"))


# ---- streams --------------------------------------------------------------------------------

_BOUNDED = {"maxFilesPerTrigger": str(writers.BATCH_FILES)}


def _topic(spark, df: DataFrame, key: str, when, file_rows: int = writers.TOPIC_FILE_ROWS) -> str:
    """Land records as a file topic in the shared folder, files in order of time."""
    path = workspace.new_path(spark, "topic")
    records = readers.to_json_records(df.withColumn("_at", when), key, "table").select(
        c("key").cast("binary").alias("key"), c("value").cast("binary").alias("value"),
        F.get_json_object("value", "$._at").cast("timestamp").alias("timestamp"),
    )
    writers.write_in_time_order(records, path, file_rows=file_rows)
    return path


def _payment_topic(spark, d, least_files: int = 1):
    """The payments in files of bounded size; in ``least_files`` or so if they would fit fewer."""
    rows = payments.required_keys(_payments(spark, d))
    file_rows = min(writers.TOPIC_FILE_ROWS, max(rows.count() // least_files, 1)) if least_files > 1 else writers.TOPIC_FILE_ROWS
    return _topic(spark, rows, "transaction_id", c("timestamp"), file_rows)


def stream_passthrough(spark, d):
    topic = _topic(spark, _finance(spark, d), "id", F.lit("2024-01-01 00:00:00"))
    out = workspace.new_path(spark, "stream-finance")
    records = readers.read_topic(spark, {}, "parquet", topic, stream=True)
    query = jobs.to_parquet(jobs.finance_passthrough(records), out, workspace.new_path(spark, "ckpt"))
    query.awaitTermination()
    return portable(spark.read.parquet(out).drop("processed_at"))


def stream_restart(spark, d):
    """The windowed count, stopped in the middle of a replay and started again from its checkpoint, state included."""
    topic = _payment_topic(spark, d, least_files=10)
    out, checkpoint = workspace.new_path(spark, "stream-counts"), workspace.new_path(spark, "ckpt")
    settings = jobs.StreamSettings(max_files=2, state_partitions=4)
    counts = lambda: jobs.payment_counts(jobs.replay(spark, topic, settings))
    jobs.stopped_after(jobs.updates_to_parquet(counts(), out, checkpoint, settings.trigger, settings), batches=2)
    jobs.updates_to_parquet(counts(), out, checkpoint, None, settings).awaitTermination()
    by = ("transaction_status", "sender_age_group")
    found = jobs.latest_updates(spark, out, by)
    return portable(found.select(c("window.start").alias("window_start"), c("window.end").alias("window_end"), *by, "count"))


def _payment_counts(spark, topic, max_files: int = writers.BATCH_FILES):
    out = workspace.new_path(spark, "stream-counts")
    settings = jobs.StreamSettings(max_files=max_files, state_partitions=jobs.REPLAY_PARTITIONS)
    records = jobs.replay(spark, topic, settings)
    query = jobs.updates_to_parquet(jobs.payment_counts(records), out, workspace.new_path(spark, "ckpt"), None, settings)
    query.awaitTermination()
    by = ("transaction_status", "sender_age_group")
    counts = jobs.latest_updates(spark, out, by)
    return portable(counts.select(c("window.start").alias("window_start"), c("window.end").alias("window_end"), *by, "count"))


def stream_tumbling_count(spark, d):
    return _payment_counts(spark, _payment_topic(spark, d))


def stream_late_drop(spark, d):
    """The same counts although every record of the oldest tenth comes once more, after all others: it is too late."""
    topic = _payment_topic(spark, d, least_files=4)
    records = spark.read.schema(readers.RECORD).parquet(topic)
    at = c("timestamp").cast("double")
    old = records.agg(F.percentile_approx(at, 0.1, 1000).alias("t"))
    late = beside(records, old).where(at < c("t")).drop("t")
    staged = workspace.new_path(spark, "late")
    late.write.parquet(staged)
    files = len(records.inputFiles())
    writers.write_in_time_order(spark.read.schema(readers.RECORD).parquet(staged), topic)  # behind all files that are there
    # half of the files or more are counted before the batch that the first late record is in
    return _payment_counts(spark, topic, max_files=max(1, min(writers.BATCH_FILES, files // 2)))


def stream_event_counts(spark, d):
    """The windowed count over the events table, replayed in order of time."""
    events, topic = testdata.table(spark, d, "events").select("ts", "event_type"), workspace.new_path(spark, "topic")
    writers.write_in_time_order(events.select(c("ts").cast("timestamp").alias("kafka_timestamp"), "event_type"), topic, "kafka_timestamp")
    rows = spark.readStream.schema("kafka_timestamp timestamp, event_type string").options(**_BOUNDED).parquet(topic)
    out = workspace.new_path(spark, "stream-events")
    query = jobs.updates_to_parquet(
        jobs.tumbling_counts(rows, ("event_type",)), out, workspace.new_path(spark, "ckpt"), None,
        jobs.StreamSettings(state_partitions=jobs.REPLAY_PARTITIONS),
    )
    query.awaitTermination()
    counts = jobs.latest_updates(spark, out, ("event_type",))
    return portable(counts.select(c("window.start").alias("window_start"), "event_type", "count"))


def stream_land_raw(spark, d):
    out = workspace.new_path(spark, "stream-raw")
    records = readers.read_topic(spark, {}, "parquet", _payment_topic(spark, d), stream=True)
    jobs.land_raw(records, out, workspace.new_path(spark, "ckpt")).awaitTermination()
    landed = spark.read.parquet(out)
    return portable(landed.select(
        "transaction_id", "amount_inr", c("year").cast("int").alias("year"), c("month").cast("int").alias("month"), "status"
    ))


# ---- the contract ---------------------------------------------------------------------------

_MONEY = {n: 2 for n in (
    "total_amount", "total_spending", "total_potential_savings", "transaction_amount", "income",
    "disposable_income", "desired_savings", "groceries", "transport", "eating_out", "entertainment", "utilities",
    "healthcare", "education", "miscellaneous", "potential_savings_groceries", "potential_savings_transport",
    "potential_savings_eating_out", "potential_savings_entertainment",
)}


def entry(spark: SparkSession) -> DataFrame:
    """The age-group spending mart at the smallest scale."""
    return portable(elt.mart_age_spending_behavior(_pairs_elt(spark, "/root/testdata/sf0.001")))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {f.__name__: f for f in (
        src_parquet, src_json_parse, src_csv_normalise, src_jdbc_to_json, src_mapping_view, snk_partitioned_raw,
        snk_audit_log, cast_numeric_safe, parse_timestamp, standardize_text, strip_inner_spaces, clamp_non_negative,
        fill_constant, impute_median, dedup_by_key, dedup_removed, dedup_full_row, except_rejected,
        anti_join_orphans, distinct_values, union_all_mapping, sample_limit, order_by_group, union_all_mart_counts,
        global_checks, dq_uniqueness, dq_nulls_raw, dq_referential, dq_report, star_fact_personal_finance,
        star_fact_upi_transaction, scd1_upsert_person, stream_passthrough, stream_tumbling_count, stream_late_drop,
        stream_event_counts, stream_land_raw, stream_restart, bucket_join_persons, bucket_join_payments, map_join_by_size,
        upsert_touched_buckets, append_fact_once, scd1_changed_only, behavior_agg_incremental, src_json_quarantine,
        audit_of_loads, cat_column_stats, dq_distribution_sketch,
    )}
    elt_features = [
        "person_id", "age_category", "age_range", "occupation_code", "occupation_category", "city_tier_code",
        "income_normalized", "disposable_income_normalized", "total_expenses", "total_potential_savings",
        "income_bracket", "expense_ratio", "savings_achievement_rate", "discretionary_spending",
        "essential_spending", "financial_health_score",
    ]
    out |= {
        "finance_clean_elt": _from(_finance_elt, lambda x: x, default=6),
        "upi_clean_elt": _from(_payments_elt, lambda x: x, default=6),
        "finance_clean_etl": _from(_finance_etl, lambda x: x, default=6),
        "upi_clean_etl": _from(_prepared_etl, payments.accepted_etl, default=6),
        "rejected_rows": _from(_prepared_etl, payments.rejected_etl, default=6),
        "finance_features_elt": _from(_finance, lambda x: finance.add_features_elt(finance.standardize_elt(x)).select(*elt_features), default=6),
        "upi_features_elt": _from(_payments, lambda x: payments.add_features_elt(payments.standardize_elt(x)).select(
            "transaction_id", "sender_age_category", "receiver_age_category", "transaction_year", "transaction_month",
            "transaction_day", "time_of_day_category", "is_weekend_flag", "is_business_hours", "merchant_category_group",
            "spending_type", "transaction_type_category", "amount_normalized", "transaction_status_code",
            "device_type_code", "network_type_code", "transaction_amount_category", "fraud_score", "is_high_value",
            "is_unusual_time"), default=6),
        "finance_features_etl": _from(_finance_etl, lambda x: x.select(
            "id", "age_category", "occupation_encoded", "city_tier_encoded",
            *[f"{n}_outlier_flag" for n in rules.OUTLIER_COLUMNS], "income_normalized", "disposable_income_normalized"), default=6),
        "upi_features_etl": _from(_prepared_etl, lambda x: x.select(
            "transaction_id", "sender_age_category", "transaction_date", "transaction_year", "transaction_month",
            "transaction_day", "amount_category", "is_weekend_bool", "time_of_day")),
        "joined_features_etl": _from(_pairs_etl, etl.joined_features_etl),
        "filter_required_keys": _from(_payments, lambda x: payments.required_keys(x).select("transaction_id", "timestamp")),
        "filter_finance_valid": _from(_finance_elt, lambda x: x.groupBy("age").agg(F.count(F.lit(1)).alias("people"), F.min("income").alias("min_income"))),
        "filter_upi_valid_elt": _from(_payments_elt, lambda x: x.groupBy("transaction_status").agg(F.count(F.lit(1)).alias("payments"), F.max("amount_inr").alias("max_amount"))),
        "filter_upi_valid_etl": _from(_prepared_etl, lambda x: payments.accepted_etl(x).select("transaction_id", "amount")),
        "filter_success": _from(_payments_elt, lambda x: payments.successful(x).select("transaction_id", "amount_inr")),
        "join_age_category_inner": _from(_pairs_etl, etl.join_age_category_inner),
        "integrated_spending_savings": _from(_pairs_elt, elt.integrated_spending_savings),
        "agg_age_merchant": _from(_pairs_etl, etl.agg_age_merchant, _MONEY),
        "fact_spending_behavior_agg": _from(_pairs_elt, elt.fact_spending_behavior_agg),
        "distribution_by_category": _from(_payments_elt, checks.payment_distribution),
        "join_coverage": _from(_pairs_elt, checks.join_coverage),
        "join_fact_to_dims": _from(_warehouse, warehouse.location_cells, _MONEY),
        "join_fact_age_merchant": _from(_warehouse, warehouse.fact_by_age_merchant, _MONEY),
        "join_fact_date": _from(_warehouse, warehouse.fact_by_date, _MONEY),
        "join_fact_occ_loc": _from(_warehouse, warehouse.fact_by_occupation_location, _MONEY),
        "fact_spending_pattern": _from(_warehouse, warehouse.fact_spending_pattern, _MONEY),
        "avg_spending_by_age": _from(_warehouse, warehouse.avg_spending_by_age),
        "top_savings_topk": _from(_warehouse, warehouse.top_savings_topk, _MONEY),
        "monthly_trends_year": _from(_warehouse, lambda w: warehouse.monthly_trends_year(w, 1995), _MONEY),
        "dq_nulls": _from(_pairs_etl, _null_checks),
        "dq_range": _from(_pairs_etl, quality_run.range_checks),
        "dq_distribution": _from(_pairs_etl, quality_run.distribution_checks),
        "star_dim_age_group": _from(_finance_elt, star.dim_age_group),
        "star_dim_person": _from(_finance_elt, star.dim_person),
        "star_dim_transaction_type": _from(_payments_elt, star.dim_transaction_type),
        "star_dim_merchant_category": _from(_payments_elt, star.dim_merchant_category),
        "star_dim_date": _from(_payments_elt, star.dim_date),
        "star_dim_location": _from(_payments_elt, star.dim_location),
    }
    for name, make in (elt.SUMMARIES | elt.MARTS).items():
        out[name] = _from(_pairs_elt, make)
    for name, make in warehouse.DIMENSIONS.items():
        out[name] = _from(_pairs_etl, make)
    for name, make in warehouse.VIEWS.items():
        out[name] = _from(_warehouse, make, _MONEY)
    return out | _LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    from oracles.statements import statements

    return statements() | _LLM_ORACLE
