from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from conftest import rows

from millrace.plans import health
from millrace.session import clear_stage, scratch_schema, shared_dir, stage, stage_alone, staging


def test_declare_and_check_layers(spark):
    prefix = "health_"
    try:
        with pytest.raises(RuntimeError, match="health_bronze, health_gold, health_silver"):
            health.health_check(spark, prefix)
        health.declare_layers(spark, prefix)
        health.declare_layers(spark, prefix)
        assert rows(health.missing_schemas(spark, [prefix + "gold", "nowhere"])) == [("nowhere",)]
        assert health.health_check(spark, prefix) == 1
        assert health.health_check(spark, prefix, catalog="spark_catalog") == 1
    finally:
        for layer in health.LAYERS:
            spark.sql(f"DROP SCHEMA IF EXISTS {prefix}{layer} CASCADE")


def test_roundtrip_drops_its_table_on_failure(spark, schema):
    table = f"{schema}.t"
    with pytest.raises(RuntimeError, match="got 0"):
        health.roundtrip(spark, table, spark.createDataFrame([], "a int"))
    assert not spark.catalog.tableExists(table)


def test_roundtrip_replaces_a_leftover(spark, schema):
    table = f"{schema}.t"
    spark.sql(f"CREATE TABLE {table} (x STRING) USING parquet")
    assert health.roundtrip(spark, table) == 1
    assert not spark.catalog.tableExists(table)


def test_staged_rows_lie_in_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5))
    assert rows(staged) == [(i,) for i in range(5)]
    assert shared_dir(spark) in staged.inputFiles()[0]
    empty = stage(spark.range(0))
    assert empty.columns == ["id"] and empty.count() == 0


def test_staged_files_can_be_deleted(spark):
    path = Path(unquote(urlparse(stage(spark.range(5)).inputFiles()[0]).path))
    assert path.exists()
    clear_stage(spark)
    assert not path.exists()
    assert stage(spark.range(2)).count() == 2


def test_what_a_job_stages_is_deleted_when_it_ends(spark):
    def place(df):
        return Path(unquote(urlparse(df.inputFiles()[0]).path)).parent

    before = stage(spark.range(5))
    with pytest.raises(KeyError), staging(spark):
        outer = place(stage(spark.range(4)))
        with staging(spark):
            inner = place(stage(spark.range(3)))
        assert outer.exists() and not inner.exists()
        raise KeyError
    assert not outer.exists() and before.count() == 5


def test_a_result_outlives_what_it_was_built_from(spark):
    on_the_way = []

    def build():
        on_the_way.append(stage(spark.range(6)))
        return on_the_way[0].where("id > 3")

    result = stage_alone(spark, build)
    assert rows(result) == [(4,), (5,)]
    assert not Path(unquote(urlparse(on_the_way[0].inputFiles()[0]).path)).exists()


def test_scratch_schema_is_dropped(spark):
    with scratch_schema(spark) as name:
        spark.range(3).write.saveAsTable(f"{name}.t")
    assert not spark.catalog.databaseExists(name)
