"""Table lists, reader options, file pick-up, drift and plan shapes of scans."""

from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import MissingColumnsError, business_columns, preview, probe_columns, project, require_columns
from tidemark.functions.hashing import bucket_count, hash_bucket, row_hash
from tidemark.functions.scalars import timestamp_literal
from tidemark.operators.drift import UnmappedTypeError, add_columns, drop_column, schema_drift, spark_types
from tidemark.operators.incremental import changed_since, full_extract, next_watermark
from tidemark.sources.files import ingest_files
from tidemark.sources.paths import TablePaths, run_name
from tidemark.sources.tables import bucket_predicates, partition_options, query_options, range_predicates, read_if_exists, read_snapshot
from tidemark.specs import choose_load_type, read_spec_table, read_specs, split_names

HEADER = "ID,SRC_DB_TYPE,DATABASE_NAME,SCHEMA_NAME,OBJ_TYPE,SRC_TBL_NAME,PRIMARY_KEY_COL,COL_NAMES,TRG_TBL_NAME,INCR_LOGIC_COL_NAME\n"


def test_table_list(spark, tmp_path):
    path = tmp_path / "tables.csv"
    path.write_text(
        HEADER
        + "1,sqlserver,shop,main,table,orders,order_id,*,orders,,,\n"
        + '2,sqlserver,shop,main,table,lines,"order_id, line_no",*,lines,"created_at, updated_at"\n'
        + "3,sqlserver,shop,main,table,logs,,*,logs,None\n"
        + '4,sqlserver,shop,main,table,stock,id,"id, qty",stock,changed_at\n'
    )
    specs = read_specs(spark, str(path))
    assert [(s.table, s.keys, s.ts_cols) for s in specs] == [
        ("orders", ("order_id",), ()),
        ("lines", ("order_id", "line_no"), ("created_at", "updated_at")),
        ("logs", (), ()),
        ("stock", ("id",), ("changed_at",)),
    ]
    assert specs[3].columns == "id, qty" and specs[0].name == "shop.main.orders"


def test_table_list_without_required_columns(spark, tmp_path):
    path = tmp_path / "tables.csv"
    path.write_text("ID,SRC_TBL_NAME\n1,orders\n")
    with pytest.raises(MissingColumnsError, match="DATABASE_NAME"):
        read_spec_table(spark, str(path))


def test_split_names():
    assert split_names('"a, b" , c') == ("a", "b", "c")
    assert split_names(None) == split_names(" NULL ") == split_names("") == split_names("None") == ()


def test_load_type():
    assert choose_load_type((), ["a"]) == "SNAPSHOT"
    assert choose_load_type(("a", "b"), ["a", "b", "c"]) == "TIMESTAMP"
    assert choose_load_type(("a", "B"), ["a", "b", "c"]) == "SNAPSHOT"
    assert choose_load_type(("a",), None) == "SNAPSHOT"


def test_reader_options():
    options = {"url": "jdbc:x", "user": "u", "password": "p"}
    assert query_options(options, "select 1") == {**options, "query": "select 1"}
    with pytest.raises(ValueError):
        query_options({**options, "dbtable": "t"}, "select 1")
    assert partition_options("id", 0, 100, 8) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}


@pytest.mark.parametrize("bounds", [[], ["m"], ["b", "m", "o'x"]])
def test_range_predicates_select_every_row_once(spark, bounds):
    names = [None, "", "a", "b", "m", "n", "o'x", "z"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = [r.name for p in range_predicates("name", bounds) for r in df.where(p).collect()]
    assert sorted(found, key=repr) == sorted(names, key=repr)


def test_bucket_predicates_select_every_row_once(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    parts = [orders.where(p) for p in bucket_predicates("pmod(xxhash64(o_orderkey), 1000)", 4)]
    assert all(p.count() > 0 for p in parts)
    whole = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert whole.count() == orders.count() == whole.select("o_orderkey").distinct().count()


def test_only_a_missing_path_means_first_run(spark, tmp_path):
    assert read_snapshot(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception) as error:
        read_snapshot(spark, str(tmp_path / "bad"))
    assert "PATH_NOT_FOUND" not in str(error.value)
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        read_if_exists(spark, str(tmp_path / "empty"))


def test_paths():
    paths = TablePaths("s3a://bucket/", "db", "s", "t")
    assert paths.snapshot == "s3a://bucket/data/db/s/t/snapshot"
    assert paths.run_dir(datetime(2024, 1, 2, 3, 4, 5)) == "s3a://bucket/data/db/s/t/incremental/20240102_030405"
    assert run_name("2024-01-02 03:04:05") == "20240102_030405"


def test_ingest_skips_corrupt_files_on_request(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    (tmp_path / "in" / "broken.parquet").write_bytes(b"broken")
    schema = T.StructType([T.StructField("id", T.LongType())])
    with pytest.raises(Exception):
        ingest_files(spark, str(tmp_path / "in"), schema).count()
    assert ingest_files(spark, str(tmp_path / "in"), schema, skip_corrupt=True).count() == 5


def test_bucket_count():
    assert [bucket_count(n) for n in (0, 1, 1_000_000, 1_000_001, 10**9)] == [1, 1, 1, 2, 64]
    assert bucket_count(100, rows_per_bucket=10, most=1000) == 10


def test_buckets_cover_extreme_keys(spark):
    df = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (None,), (0,)], "k long")
    got = [r.bucket for r in hash_bucket(df, ["k"], 7).collect()]
    assert all(0 <= b < 7 for b in got)


def test_hash_modes(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "k int, a string, b string")
    safe = [r.hash_val for r in row_hash(df, ["K"]).orderBy("k").collect()]
    compat = [r.hash_val for r in row_hash(df, ["k"], mode="compat").orderBy("k").collect()]
    assert safe[0] != safe[1] and compat[0] == compat[1]
    with pytest.raises(ValueError):
        row_hash(df, ["k"], mode="other")


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, Soft_Delete int, `C d` int")
    assert business_columns(df) == ["a.b", "C d"]
    assert probe_columns(df) == ["a.b", "Soft_Delete", "C d"]
    assert project(df, ["a.b"]).collect() == [(1,)]
    assert project(df, "*").columns == df.columns
    assert preview(spark.range(100), 10).count() == 10
    with pytest.raises(MissingColumnsError):
        require_columns(df, ["c D", "zzz"])


def test_times_with_a_zone_are_taken_as_utc(spark):
    value = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    assert spark.range(1).select(timestamp_literal(value)).first()[0] == datetime(2024, 1, 1, 12)


def test_drift(spark):
    source = spark.createDataFrame([], "K int, v bigint, extra date")
    target = spark.createDataFrame([], "k int, V int, gone string, is_deleted int")
    drift = schema_drift(source, target)
    assert drift and list(drift.added) == ["extra"] and drift.removed == ["gone"] and list(drift.retyped) == ["V"]
    assert add_columns(target, drift.added).columns == ["k", "V", "gone", "is_deleted", "extra"]
    assert not schema_drift(target, target)
    with pytest.raises(ValueError):
        drop_column(target, "nothing")
    assert spark_types({"a": "INT", "b": "Datetime"}) == {"a": "int", "b": "timestamp_ntz"}
    with pytest.raises(UnmappedTypeError, match="geography"):
        spark_types({"a": "int", "g": "geography"})


def test_extract_reaches_the_scan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    df = project(changed_since(orders, ["o_orderdate"], "2000-01-01"), "o_orderkey")
    plan = df._jdf.queryExecution().toString()
    assert "GreaterThan(o_orderdate,2000-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert full_extract(orders, "o_orderkey", ["o_orderdate", "O_ORDERKEY"]).columns == ["o_orderkey", "o_orderdate"]


def test_next_watermark_ignores_nulls(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), None), (None, datetime(2023, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert next_watermark(df, ["a", "b"]) == datetime(2024, 1, 1)
    assert next_watermark(df.where("false"), ["a"]) is None
    assert changed_since(df, ["a", "b"], "2023-06-01").count() == 1
    with pytest.raises(ValueError):
        changed_since(df, ["a"], "2023-06-01", nulls="maybe")


def test_comparison_has_no_join_and_reads_hashes_only(spark, tmp_path):
    from tidemark.operators.diff import snapshot_diff

    wide = spark.range(100).select("id", *[F.lit("x").alias(f"c{i}") for i in range(5)])
    row_hash(wide, ["id"]).write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    plan = snapshot_diff(stored, stored, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("ReadSchema: struct<id:bigint,hash_val:string>") == 2


def test_catalog_table_gains_mapped_columns(spark):
    from tidemark.operators.drift import alter_table_add

    spark.range(3).write.mode("overwrite").saveAsTable("grows")
    assert alter_table_add(spark, "grows", {"ID": "int", "name": "VARCHAR", "at": "datetime"}) == ["name", "at"]
    assert dict(spark.table("grows").dtypes) == {"id": "bigint", "name": "string", "at": "timestamp_ntz"}
    with pytest.raises(UnmappedTypeError):
        alter_table_add(spark, "grows", {"shape": "geography", "x": "int"})
    assert "x" not in spark.table("grows").columns
