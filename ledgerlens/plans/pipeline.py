"""Whole runs: raw inputs to written tables, each stage reading what the one before wrote."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import finance, payments
from ..operators.pairs import PairRelation
from ..sources import bucketed, writers
from ..sources.versioned import VersionedTable
from ..sources.workspace import new_path
from . import elt, etl, facts, quality_run, star, warehouse


def run_elt(spark: SparkSession, finance_raw: DataFrame, payments_raw: DataFrame, database: str,
            as_of: Column | None = None, audit_log: str | None = None) -> DataFrame:
    """Clean tables, summaries, marts and statistics into ``database``; returns the mart counts.

    Every table that is saved gets a row in the audit log, a folder (``audit_log``, else a new one
    in the shared folder), with the rows that were counted while it was written. A run that ends
    with a table missing or empty fails.
    """
    writers.create_database(spark, database, "Curated tables for analytics")
    as_of = F.current_timestamp() if as_of is None else as_of
    log = audit_log or new_path(spark, "audit")

    def save(df: DataFrame, name: str, **options) -> DataFrame:
        writers.audited(df, lambda rows: writers.save_table(rows, f"{database}.{name}", mode="overwrite", **options), name, "INITIAL_LOAD", log)
        return spark.table(f"{database}.{name}")

    people = save(finance.clean_elt(finance_raw, as_of), "clean_india_personal_finance")
    clean = f"{database}.clean_upi_transaction"
    sends = bucketed.save_bucketed(payments.clean_elt(payments_raw, as_of), clean, facts.PAYMENT_BUCKETS, "transaction_id", mode="overwrite")
    pairs = elt.joined(sends, people)
    for name, make in elt.SUMMARIES.items():
        save(make(pairs).withColumn("created_at", as_of), name)
    marts = {n: save(make(pairs).withColumn("mart_created_at", as_of), n) for n, make in elt.MARTS.items()}
    save(elt.fact_spending_behavior_agg(pairs), "fact_spending_behavior_agg", partition_by=("year", "month"))

    dims = {"ages": save(star.dim_age_group(people), "dim_age_group"), "types": save(star.dim_transaction_type(sends), "dim_transaction_type"),
            "merchants": save(star.dim_merchant_category(sends), "dim_merchant_category"), "places": save(star.dim_location(sends), "dim_location")}
    save(star.dim_date(sends), "dim_date")
    facts.save_person_tables(people, dims["ages"], database, as_of)
    facts.save_payment_facts(sends, dims, database)
    writers.analyze(spark, [f"{database}.{n}" for n in ("clean_india_personal_finance", *marts)])
    writers.require_rows(spark, [f"{database}.{n}" for n in ("clean_india_personal_finance", "clean_upi_transaction", "fact_personal_finance", "fact_upi_transaction")])
    return elt.mart_counts(marts)


def _staged(df: DataFrame, path: str) -> DataFrame:
    writers.overwrite_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def stage_etl(finance_raw: DataFrame, payments_raw: DataFrame, base: str, as_of: Column | None = None,
              rejected: bool = True) -> PairRelation:
    """Clean both inputs into tables under ``base`` and pair what was written.

    Reading the written rows back keeps every later result off the cleaning shuffles.
    """
    people = _staged(finance.clean_etl(finance_raw, as_of=as_of), f"{base}/clean/finance")
    prepared = payments.prepared_etl(payments_raw)
    if rejected:
        prepared = _staged(prepared, f"{base}/staged/payments")
        writers.overwrite_parquet(payments.rejected_etl(prepared), f"{base}/rejected/payments")
    sends = _staged(payments.accepted_etl(prepared, as_of), f"{base}/clean/payments")
    return etl.joined(sends, people)


def staged_warehouse(pairs: PairRelation, base: str) -> warehouse.Warehouse:
    """Dimensions written under ``base`` on first use, facts lazy."""
    return warehouse.build(pairs, lambda df, name: _staged(df, f"{base}/{name}"))


def run_etl(spark: SparkSession, finance_raw: DataFrame, payments_raw: DataFrame, base: str, database: str,
            as_of: Column | None = None, load_id: str | None = None) -> DataFrame:
    """Clean and rejected sets under ``base``, the star schema in ``database``, the quality report as JSON.

    Loads of the warehouse are in the audit log ``base/audit``. With a ``load_id`` the payments
    are also appended to the ledgered fact ``base/fact_payments``, once however often the run is
    tried. Returns the quality report.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    pairs = stage_etl(finance_raw, payments_raw, base, as_of)
    writers.overwrite_parquet(etl.agg_age_merchant(pairs), f"{base}/clean/aggregated")
    checks = _staged(
        quality_run.all_check_rows(spark, pairs, *etl.CHECKED_COLUMNS), f"{base}/quality/checks"
    )
    report = quality_run.quality.quality_report(checks).withColumn("timestamp", as_of)
    writers.write_json_report(report, f"{base}/quality/report")
    built = load_warehouse(spark, pairs, database, as_of, f"{base}/audit")
    if load_id is not None:
        months = ("transaction_year", "transaction_month")
        fact = VersionedTable(spark, f"{base}/fact_payments", partition_by=months)
        fact.append_once(warehouse.payment_half(pairs, built.dim_age_category, built.dim_merchant_category), load_id)
    return report


def load_persons(table: VersionedTable, people: DataFrame, load_id: str) -> int:
    """A full delivery of the persons into their dimension; returns how many rows were new or had changed.

    Rows are compared by digest, and only the key buckets of those that changed are written.
    """
    if load_id in table.manifest().loads:
        return 0
    if table.manifest().schema is None:
        changed = people
    else:
        changed = star.changed_rows(table.read(), people, table.key)
    path = new_path(people.sparkSession, "changed")
    changed.write.parquet(path)
    rows = people.sparkSession.read.schema(people.schema).parquet(path)
    table.upsert(rows, load_id=load_id)
    return rows.count()


def load_warehouse(spark: SparkSession, pairs: PairRelation, database: str, as_of: Column, audit_log: str | None = None) -> warehouse.Warehouse:
    """Dimensions and persons merged by key, partition-wise refresh of the payments, views registered.

    Keys depend on natural keys alone, so facts of earlier loads keep their dimensions. A
    person that comes again replaces the row from before.
    """
    writers.create_database(spark, database, "Star schema of spending patterns")

    def load(df: DataFrame, name: str, partition_by=()) -> DataFrame:
        full = f"{database}.{name}"
        writers.create_table(spark, full, {f.name: f.dataType.simpleString() for f in df.schema.fields},
                             partition_by=partition_by)
        def write(rows: DataFrame) -> None:
            if partition_by:
                writers.refresh_partitions(rows, full)
            else:
                writers.merge_by_key(rows, full, warehouse.TABLE_KEYS[name])

        if audit_log:
            writers.audited(df, write, name, "REFRESH" if partition_by else "MERGE", audit_log)
        else:
            write(df)
        return spark.table(full)

    built = warehouse.build(pairs, load)
    load(built.fact_payments.withColumn("load_timestamp", as_of), "fact_payments",
         ("transaction_year", "transaction_month"))
    load(built.fact_persons.withColumn("load_timestamp", as_of), "fact_persons")
    loaded = warehouse.Warehouse(lambda name: spark.table(f"{database}.{name}"))
    for name in warehouse.DIMENSIONS:
        getattr(built, name)  # those no fact half has asked for yet
    for name, view in warehouse.VIEWS.items():
        view(loaded).createOrReplaceTempView(name)
    return loaded
