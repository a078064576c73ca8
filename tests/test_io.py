"""Sources, sinks, catalog and whole runs."""

import json

from pyspark.sql import functions as F

from ledgerlens.functions import keys, rules
from ledgerlens.plans import pipeline
from ledgerlens.sources import readers, testdata, workspace, writers
from ledgerlens.sources.versioned import VersionedTable

SMALL = "/root/testdata/sf0.001"


def as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def test_shared_folder_comes_from_the_session(spark):
    assert workspace.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_parquet_overwrite_round_trip(spark, tmp_path):
    writers.overwrite_parquet(spark.range(5), str(tmp_path / "x"))
    writers.overwrite_parquet(spark.range(3), str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).count() == 3


def test_landing_is_found_and_pruned(spark, tmp_path):
    raw = testdata.payments_raw(spark, SMALL)
    path = str(tmp_path / "landing")
    writers.land_raw_payments(raw, path)
    columns = {n: t for n, t in raw.dtypes}
    spark.sql("CREATE DATABASE IF NOT EXISTS land")
    writers.external_parquet(spark, "land.payments", columns | {"year": "string", "month": "string", "status": "string"},
                             path, ("year", "month", "status"))
    table = spark.table("land.payments")
    assert table.count() == raw.count()
    one = table.where("year = '1995' AND status = 'FAILED'")
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().toString()
    assert one.count() == raw.where("timestamp LIKE '1995%' AND trim(transaction_status) = 'failed'").count()
    writers.analyze(spark, ["land.payments"])
    assert "rows" in str(spark.sql("DESCRIBE EXTENDED land.payments").where("col_name = 'Statistics'").first())


def test_tables_by_name_and_idempotent_partitions(spark):
    writers.create_database(spark, "ddl", "test")
    writers.create_table(spark, "ddl.dim", {"id": "int", "name": "string"}, "a dimension")
    for _ in range(2):
        writers.insert_overwrite(spark.createDataFrame([("x", 1)], "name string, id int"), "ddl.dim")
    assert [tuple(r) for r in spark.table("ddl.dim").collect()] == [(1, "x")]
    writers.create_table(spark, "ddl.fact", {"v": "int", "y": "int"}, partition_by=("y",))
    rows = spark.createDataFrame([(1, 2023), (2, 2024)], "v int, y int")
    writers.refresh_partitions(rows, "ddl.fact")
    writers.refresh_partitions(rows.where("y = 2024"), "ddl.fact")
    assert spark.table("ddl.fact").count() == 2
    writers.append_rows(rows, "ddl.fact")
    assert spark.table("ddl.fact").count() == 4
    writers.create_table(spark, "ddl.bucketed", {"k": "bigint"}, bucket_by=(8, "k"))
    assert "8" in str(spark.sql("DESCRIBE EXTENDED ddl.bucketed").where("col_name = 'Num Buckets'").first())
    counts = {r.table_name: r.row_count for r in writers.validate_tables(spark, ["ddl.dim", "ddl.none"]).collect()}
    assert counts == {"ddl.dim": 1, "ddl.none": -1}


def test_csv_seed_gets_stable_ids(spark, tmp_path):
    raw = testdata.finance_raw(spark, SMALL).drop("id")
    raw.write.option("header", True).csv(str(tmp_path / "seed"))
    first = readers.read_finance_seed(spark, str(tmp_path / "seed")).collect()
    again = readers.read_finance_seed(spark, str(tmp_path / "seed")).collect()
    assert sorted(r.id for r in first) == list(range(1, len(first) + 1))
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_json_records_keep_nulls_and_count_malformed(spark):
    df = spark.createDataFrame([(1, None, 30)], "id int, income double, age int")
    value = json.loads(readers.to_json_records(df, "id", "postgres", as_of()).first().value)
    assert value == {"id": 1, "income": None, "age": 30, "_extracted_at": "2024-06-01 00:00:00", "_source": "postgres"}
    records = spark.createDataFrame([('{"id": 1}',), ("{oops",)], "value string")
    assert readers.malformed_records(records, readers.FINANCE_STREAM).first().asDict() == {"records": 2, "malformed": 1}
    parsed = readers.parse_records(records, readers.FINANCE_STREAM).collect()
    assert len(parsed) == 2 and parsed[1].id is None


def test_metadata_and_topic_options(spark):
    df = readers.with_extract_metadata(spark.range(1), "csv_kafka", as_of())
    assert df.first().source_system == "csv_kafka" and str(df.first().extract_date) == "2024-06-01 00:00:00"
    named = readers.staging_names(spark.range(1).selectExpr("id", "'t' AS _extracted_at", "'s' AS _source"), as_of())
    assert named.columns == ["id", "extracted_at", "source_system", "processed_at"]
    assert readers.kafka_options("h:1", "t", "latest", stream=True)["failOnDataLoss"] == "false"
    assert [r.age_range for r in readers.age_group_mapping(spark).collect()] == [b[2] for b in rules.AGE_BANDS]


def test_elt_run_writes_every_table(spark):
    log = workspace.new_path(spark, "audit-test")
    counts = pipeline.run_elt(spark, testdata.finance_raw(spark, SMALL), testdata.payments_raw(spark, SMALL), "elt_run", as_of(), log)
    for row in spark.read.parquet(log).collect():
        assert row.status == "SUCCESS" and row.record_count == spark.table(f"elt_run.{row.table_name}").count()
    found = {r.mart_name: r.record_count for r in counts.collect()}
    assert len(found) == 5 and all(found.values())
    upi = spark.table("elt_run.fact_upi_transaction")
    assert upi.count() == spark.table("elt_run.clean_upi_transaction").count()
    assert spark.table("elt_run.clean_upi_transaction").columns[-1] == "processed_at"


def test_etl_run_twice_gives_one_load(spark, tmp_path):
    inputs = [testdata.as_text(f(spark, SMALL)) for f in (testdata.finance_raw, testdata.payments_raw)]
    for i in range(2):
        report = pipeline.run_etl(spark, *inputs, str(tmp_path / f"run{i}"), "etl_run", as_of(), "load 1").first()
    clean, rejected = (spark.read.parquet(str(tmp_path / "run1" / k / "payments")) for k in ("clean", "rejected"))
    assert clean.count() + rejected.count() == inputs[1].select("transaction_id").distinct().count()
    facts = spark.table("etl_run.fact_payments")
    assert facts.count() == clean.count() and facts.where("merchant_category_id IS NULL OR age_category_id IS NULL").isEmpty()
    assert report.total_checks == report.passed_checks + report.failed_checks
    assert spark.read.json(str(tmp_path / "run1" / "quality" / "report")).count() == 1
    again = VersionedTable(spark, str(tmp_path / "run1" / "fact_payments"))
    assert again.manifest().loads == ["load 1"] and again.read().count() == facts.count()
    audit = {r.table_name: r.record_count for r in spark.read.parquet(str(tmp_path / "run1" / "audit")).collect()}
    assert audit["fact_payments"] == facts.count() and set(audit) >= {"dim_date", "dim_location", "fact_persons"}
    assert spark.table("v_spending_by_age").count() > 0


def test_a_second_load_keeps_the_names_of_the_first(spark, tmp_path):
    people, sends = (testdata.as_text(f(spark, SMALL)) for f in (testdata.finance_raw, testdata.payments_raw))
    year = F.substring("timestamp", 1, 4)
    first = sends.where((year == "1995") & ~F.col("merchant_category").isin("Fuel", "Insurance"))
    second = sends.where(year == "1996").withColumn("merchant_category", F.when(F.col("merchant_category") == "Food", "Aquarium").otherwise(F.col("merchant_category")))

    def names():
        facts, dims = spark.table("two_loads.fact_payments"), spark.table("two_loads.dim_merchant_category")
        facts = facts.where("transaction_year = 1995")
        return {r[0]: r[1] for r in facts.join(dims, "merchant_category_id", "left").groupBy("category_name").count().collect()}

    seen = []
    for i, part in enumerate((first, second)):
        pairs = pipeline.stage_etl(people, part, str(tmp_path / f"load{i}"), as_of(), rejected=False)
        pipeline.load_warehouse(spark, pairs, "two_loads", as_of())
        seen.append(names())
    assert seen[0] == seen[1] and None not in seen[1]
    facts = spark.table("two_loads.fact_payments")
    for dim, key in (("dim_merchant_category", "merchant_category_id"), ("dim_date", "date_id"), ("dim_age_category", "age_category_id")):
        assert facts.join(spark.table(f"two_loads.{dim}"), key, "left_anti").isEmpty()
        assert keys.id_collisions(spark.table(f"two_loads.{dim}"), key).isEmpty()
    assert spark.table("two_loads.fact_persons").count() == spark.table("two_loads.fact_persons").select("finance_id").distinct().count()
