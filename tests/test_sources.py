import pathlib

import pytest
from helpers import day, moment, rows

from pyspark.sql import functions as F

from tidemark.sources import export, extracts, layout, warehouse


def numbers(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "n long")


def test_parameters_are_bound_as_text(spark):
    result = warehouse.run_query(spark, "SELECT :a AS a, :b || '!' AS b, :c AS c", {"a": 7, "b": "it's", "c": None})
    assert rows(result) == [("7", "it's!", None)]
    assert result.schema["a"].dataType.simpleString() == "string"
    assert rows(warehouse.run_query(spark, "SELECT 1")) == [(1,)]


def test_write_modes(spark, database):
    table = f"{database}.t"
    warehouse.load_table(numbers(spark, 1), table)
    warehouse.load_table(numbers(spark, 2), table)
    assert rows(spark.table(table), "n") == [(1,), (2,)]
    with pytest.raises(ValueError, match="already has rows"):
        warehouse.load_table(numbers(spark, 3), table, "WRITE_EMPTY")
    warehouse.load_table(numbers(spark, 4), table, "WRITE_TRUNCATE")
    assert rows(spark.table(table)) == [(4,)]
    with pytest.raises(ValueError, match="unknown write mode"):
        warehouse.load_table(numbers(spark, 5), table, "APPEND")


def test_write_empty_fills_an_existing_empty_table(spark, database):
    spark.sql(f"CREATE TABLE {database}.t (n BIGINT)")
    warehouse.load_table(numbers(spark, 1), f"{database}.t", "WRITE_EMPTY")
    assert rows(spark.table(f"{database}.t")) == [(1,)]


def test_append_goes_by_column_name(spark, database):
    table = f"{database}.t"
    warehouse.load_table(spark.createDataFrame([(1, 2)], "a int, b int"), table)
    warehouse.load_table(spark.createDataFrame([(4, 3)], "b int, a int"), table)
    assert rows(spark.table(table).select("a", "b"), "a") == [(1, 2), (3, 4)]


def test_a_table_may_be_replaced_by_a_query_on_itself(spark, database):
    table = f"{database}.t"
    warehouse.load_table(numbers(spark, 1, 2, 3), table)
    warehouse.query_to_table(spark, f"SELECT n + 1 AS n FROM {table} WHERE n > 1", table)
    assert rows(spark.table(table), "n") == [(3,), (4,)]


def test_a_partitioned_table_may_be_replaced(spark, database):
    table = f"{database}.t"
    for step in (1, 2):
        df = spark.range(30).selectExpr(f"id * {step} AS n", f"id % {step + 1} AS p")
        warehouse.replace_table(df, table, partition_by=["p"])
        assert spark.table(table).agg(F.sum("n")).first()[0] == 435 * step
        assert spark.table(table).where("p = 0").count() == 30 // (step + 1)


def test_a_failed_replacement_leaves_the_table(spark, database):
    table = f"{database}.t"
    warehouse.load_table(numbers(spark, 1), table)
    with pytest.raises(Exception):
        warehouse.query_to_table(spark, f"SELECT n / 0 AS n FROM {table}", table)
    assert rows(spark.table(table)) == [(1,)]


def test_an_empty_result_is_not_loaded(spark, database):
    table = f"{database}.t"
    result = spark.createDataFrame([(day("2024-02-01"), 5)], "cohort_month date, n int")
    assert warehouse.load_results(result, table)
    assert not warehouse.load_results(result.where("n > 5"), table)
    assert rows(spark.table(table)) == [("2024-02", 5)]
    assert warehouse.load_results(result.withColumn("cohort_month", F.lit("x")), table, "WRITE_APPEND")
    assert rows(spark.table(table), "cohort_month") == [("2024-02", 5), ("x", 5)]
    assert [found.name for found in spark.catalog.listTables(database) if not found.isTemporary] == ["t"]


def test_csv_has_a_header_and_one_folder_per_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "n int, t string").repartition(2)
    paths = export.export_csv({"first": df, "second": df}, str(tmp_path), single_file=True)
    assert [path.rsplit("/", 1)[1] for path in paths] == ["first", "second"]
    assert len(list((tmp_path / "first").glob("part-*.csv"))) == 1
    assert rows(spark.read.option("header", True).csv(paths[1]), "n") == [("1", "a,b"), ("2", None)]


def test_extracts(spark):
    transactions = spark.createDataFrame(
        [(1, 1, day("2023-01-31"), 1.0, "p", "r", "completed"), (1, 2, day("2023-01-30"), 1.0, "p", "r", "completed"),
         (1, 3, day("2024-01-01"), 1.0, "p", "r", "open"), (1, 4, day("2024-01-01"), 1.0, "p", "r", None)],
        "customer_id long, transaction_id long, transaction_date date, amount double, product_line string, region string, status string",
    )
    assert [row[1] for row in rows(extracts.extract_transactions(transactions, "2024-01-31"))] == [1]
    logins = spark.createDataFrame(
        [(1, day("2024-01-01")), (1, day("2024-02-01")), (2, day("2023-01-01")), (3, day("2023-12-02"))], "customer_id long, login_date date"
    )
    result = extracts.extract_customer_logins(logins, "2024-03-01")
    assert rows(result, "customer_id") == [(1, day("2024-02-01"), 2), (3, day("2023-12-02"), 1)]
    stages = spark.createDataFrame([(n, n, "s", None, 1, "x", flag) for n, flag in enumerate([True, False, None])],
        "lead_id long, customer_id long, stage_name string, stage_entered_at timestamp, sales_rep_id long, segment string, is_current_stage boolean")
    assert [row[0] for row in rows(extracts.extract_funnel_events(stages))] == [0]


RAW = "customer_id long, event_type string, event_value double, session_id string, platform string, created_at timestamp_ntz, region string"


def raw_events(spark, *events):
    return spark.createDataFrame([(c, "view", 1.0, "s", "web", moment(t), r) for c, t, r in events], RAW)


def layout_of(spark, table):
    """What the definition of a table says, without its statistics and times."""
    described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    names = ("Provider", "Type", "Location", "Num Buckets", "Bucket Columns", "Storage Properties", "# Partition Information")
    return {name: described.get(name) for name in names} | {"owned": "team=finance" in described.get("Table Properties", "")}


@pytest.mark.parametrize("clause", ["", "PARTITIONED BY (p)", "CLUSTERED BY (n) INTO 4 BUCKETS", "PARTITIONED BY (p) CLUSTERED BY (n) INTO 2 BUCKETS"])
@pytest.mark.parametrize("external", [False, True])
def test_loads_keep_the_table_what_it_is(spark, database, tmp_path, clause, external):
    table = f"{database}.t"
    place = f"LOCATION '{tmp_path}/place'" if external else ""
    spark.sql(f"CREATE TABLE {table} (n BIGINT, p STRING) USING ORC OPTIONS ('compression' 'snappy') {clause} {place} TBLPROPERTIES ('team' = 'finance')")
    before, partitions = layout_of(spark, table), [column.isPartition for column in spark.catalog.listColumns(table)]
    few = spark.createDataFrame([("01", 1), ("007", 2)], "p string, n long")
    warehouse.load_table(few, table)
    warehouse.load_table(few.withColumn("n", F.col("n") + 10), table)
    assert sorted(rows(spark.table(table).select("n", "p"))) == [(1, "01"), (2, "007"), (11, "01"), (12, "007")]
    warehouse.load_table(few, table, "WRITE_TRUNCATE")
    warehouse.query_to_table(spark, f"SELECT n * 2 AS n, p FROM {table}", table)
    warehouse.load_results(few, table, "WRITE_APPEND")
    layout.compact_table(spark, table)
    assert sorted(rows(spark.table(table).select("n", "p"))) == [(1, "01"), (2, "007"), (2, "01"), (4, "007")]
    assert layout_of(spark, table) == before
    assert [column.isPartition for column in spark.catalog.listColumns(table)] == partitions
    assert rows(layout.file_codecs(spark, table).select("codec")) == [("snappy",)]
    assert [found.name for found in spark.catalog.listTables(database) if not found.isTemporary] == ["t"]


def test_a_replacement_that_fails_late_can_be_committed_again(spark, database):
    table = f"{database}.t"
    warehouse.load_table(numbers(spark, 1), table)
    staged = warehouse.stage_table(numbers(spark, 2), table)

    def broken(df):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        warehouse.commit_table(spark, staged, table, broken)
    assert rows(spark.table(table)) == [(1,)]
    warehouse.commit_table(spark, staged, table)
    assert rows(spark.table(table)) == [(2,)]


def test_other_columns_replace_the_definition(spark, database):
    table = f"{database}.t"
    warehouse.load_table(numbers(spark, 1), table)
    warehouse.replace_table(spark.createDataFrame([("x",)], "t string"), table)
    assert rows(spark.table(table)) == [("x",)]


def test_only_loaded_partitions_are_replaced(spark, database):
    table = f"{database}.events"
    layout.create_event_table(spark, table)
    layout.create_event_table(spark, table)  # a second time changes nothing
    first = raw_events(spark, (1, "2024-01-15 10:00:00", "US"), (2, "2024-01-16 10:00:00", "US"), (3, "2023-12-31 23:59:59", "US"))
    layout.load_event_partitions(first, table, "2024-01-01")
    layout.load_event_partitions(raw_events(spark, (9, "2024-01-16 00:00:00", "US"), (8, "2024-01-16 00:00:00", "EU")), table, "2024-01-01")
    layout.load_event_partitions(first.limit(0), table, "2024-01-01")
    assert rows(spark.table(table).select("customer_id", "event_date", "region"), "customer_id") == [
        (1, "2024-01-15", "US"),
        (8, "2024-01-16", "EU"),
        (9, "2024-01-16", "US"),
    ]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(ValueError, match="more than 1 partitions"):
        layout.load_event_partitions(first, table, "2024-01-01", max_partitions=1)


def test_bucketed_spend_with_a_hot_customer_and_repeated_rows(spark, database):
    people = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "a", 1.0), (2, "a", 1.0), (3, "a", 0.0)], "customer_id long, segment string, lifetime_value double")
    payments = spark.createDataFrame([(1, 1.5)] * 50 + [(2, 2.0), (4, 9.0)], "customer_id long, amount double")
    layout.write_bucketed(people, f"{database}.people", "customer_id", buckets=4)
    layout.write_bucketed(payments, f"{database}.payments", "customer_id", buckets=4)
    for hot_rows in (10, 1000):
        result = layout.bucketed_spend(spark, f"{database}.people", f"{database}.payments", hot_rows)
        assert rows(result, "customer_id", "segment") == [(1, "a", 75.0), (1, "b", 75.0), (2, "a", 4.0)]


def test_codecs(spark, tmp_path):
    df = spark.range(1000)
    for tier, codec in (("hot", "snappy"), ("cold", "zlib")):
        layout.write_orc(df, str(tmp_path / tier), tier)
        assert list((tmp_path / tier).glob(f"part-*.{codec}.orc"))
        assert spark.read.orc(str(tmp_path / tier)).count() == 1000


def files(folder):
    return len(list(pathlib.Path(folder.removeprefix("file:")).rglob("part-*.orc")))


def test_compaction_keeps_partition_values_as_they_are(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    df = spark.createDataFrame([(n, region) for n in range(20) for region in ("01", "007", "1")], "n long, region string")
    df.repartition(5).write.partitionBy("region").orc(source)
    layout.compact_files(spark, source, target, partition_by=["region"])
    assert sorted(path.name for path in pathlib.Path(target).glob("region=*")) == ["region=007", "region=01", "region=1"]
    assert all(".snappy." in path.name for path in pathlib.Path(target).rglob("part-*.orc"))


def test_compaction_notices_changed_rows(spark):
    with pytest.raises(RuntimeError, match="hash"):
        layout._same_rows(numbers(spark, 1, 2), numbers(spark, 1, 3))
    layout._same_rows(numbers(spark, 1, 2), numbers(spark, 2, 1))


def test_a_bucket_too_large_for_a_task(spark, database):
    people = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id long, segment string")
    payments = spark.createDataFrame([(1, 1.5), (2, 2.0), (2, 2.5)], "customer_id long, amount double")
    layout.write_bucketed(people, f"{database}.people", "customer_id", buckets=2)
    layout.write_bucketed(payments, f"{database}.payments", "customer_id", buckets=2)
    assert layout.largest_bucket(spark, f"{database}.payments") > 0
    for bucket_bytes in (1, 1 << 30):
        result = layout.bucketed_spend(spark, f"{database}.people", f"{database}.payments", bucket_bytes=bucket_bytes)
        assert rows(result, "customer_id") == [(1, "a", 1.5), (2, "b", 4.5)]


def test_compaction_keeps_rows_and_saves_files(spark, database, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(5000).repartition(40).write.orc(source)
    layout.compact_files(spark, source, target)
    assert files(source) == 40
    assert files(target) == 1
    assert spark.read.orc(target).agg(F.sum("id"), F.count("id")).first() == (12497500, 5000)

    table = f"{database}.parts"
    spark.range(2000).selectExpr("id", "id % 3 AS p").repartition(20).write.format("orc").partitionBy("p").saveAsTable(table)
    before = files(layout.table_location(spark, table))
    layout.compact_table(spark, table)
    assert before == 60
    assert files(layout.table_location(spark, table)) == 3
    assert spark.table(table).where("p = 1").count() == 667
    assert [column.name for column in spark.catalog.listColumns(table) if column.isPartition] == ["p"]


def test_compaction_splits_at_the_target_size(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(200_000).selectExpr("id", "uuid() AS u").repartition(16).write.orc(source)
    total = sum(path.stat().st_size for path in pathlib.Path(source).rglob("*.orc"))
    layout.compact_files(spark, source, target, target_bytes=total // 4 + 1)
    assert 4 <= files(target) <= 6


def test_statistics(spark, database):
    table = f"{database}.events"
    layout.create_event_table(spark, table)
    layout.load_event_partitions(raw_events(spark, (1, "2024-01-15 10:00:00", "US"), (2, "2024-01-16 10:00:00", "US")), table, "2024-01-01")
    layout.analyze_table(spark, table)
    layout.analyze_table(spark, table, {"event_date": "2024-01-15", "region": "US"})
    layout.analyze_table(spark, table, columns=["customer_id"])
    described = dict(rows(spark.sql(f"DESCRIBE EXTENDED {table} customer_id")))
    assert (described["min"], described["max"], described["num_nulls"]) == ("1", "2", "0")
    partition = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION (event_date='2024-01-15', region='US')")
    assert "1 rows" in partition.where("col_name = 'Partition Statistics'").first()[1]
    with pytest.raises(ValueError):
        layout.analyze_table(spark, table, {"region": "US"}, ["customer_id"])
