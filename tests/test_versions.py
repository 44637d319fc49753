"""Versioned tables: killed runs, repeated batches, conflicts, schema changes."""

import os

import pytest
from pyspark.sql import types as T

from pricelens.sources.evolution import SchemaChangeError, conform, reconcile, widened
from pricelens.sources.versions import ConflictError, VersionedTable

SCHEMA = "period string, k string, value string, _ingested_at int"


def rows(t, *a):
    return sorted(map(tuple, t.read(*a).select("period", "k", "value", "_ingested_at").collect()), key=repr)


@pytest.fixture()
def table(spark, tmp_dir):
    t = VersionedTable(spark, tmp_dir + "/t", "period")
    t.merge(spark.createDataFrame([("2024-01-01", "a", "1", 1), ("2024-01-01", "b", "2", 1), ("2024-01-08", "a", "3", 1),
                                   (None, "n", "9", 1), ("x/y z", "s", "8", 1)], SCHEMA), ["period", "k"], batch=("w", 0))
    return t


UPDATE = [("2024-01-01", "a", "1b", 2), ("2024-01-15", "a", "4", 2), (None, "n", "9b", 2), ("x/y z", "s", "8b", 2)]


def test_merge_touches_only_its_partitions(spark, table):
    before = table.head()
    m = table.merge(spark.createDataFrame(UPDATE, SCHEMA), ["period", "k"], batch=("w", 1))
    assert m.parts["period=2024-01-08"] == before.parts["period=2024-01-08"]
    assert m.parts["period=2024-01-01"] != before.parts["period=2024-01-01"]
    assert rows(table) == sorted([("2024-01-01", "a", "1b", 2), ("2024-01-01", "b", "2", 1), ("2024-01-08", "a", "3", 1),
                                  ("2024-01-15", "a", "4", 2), (None, "n", "9b", 2), ("x/y z", "s", "8b", 2)], key=repr)
    assert len(rows(table, 1)) == 5  # the version before is still there
    assert table.read(values=["2024-01-15"]).count() == 1 and table.read(values=["nowhere"]).count() == 0


def test_the_same_batch_twice_changes_nothing(spark, table):
    update = spark.createDataFrame(UPDATE, SCHEMA)
    first = table.merge(update, ["period", "k"], batch=("w", 1))
    assert table.merge(update, ["period", "k"], batch=("w", 1)) == first
    assert table.merge(update, ["period", "k"], batch=("other", 0)).version == first.version + 1


def test_a_run_killed_before_the_switch_leaves_the_table(spark, table, monkeypatch):
    update, before = spark.createDataFrame(UPDATE, SCHEMA), rows(table)

    def killed(self, manifest):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_switch", killed)
        with pytest.raises(KeyboardInterrupt):
            table.merge(update, ["period", "k"], batch=("w", 1))
    assert rows(table) == before and table.head().version == 1
    table.merge(update, ["period", "k"], batch=("w", 1))
    once = rows(table)
    clean = VersionedTable(spark, table.path + "_clean", "period")
    clean.merge(table.read(1), ["period", "k"])
    clean.merge(update, ["period", "k"])
    assert once == rows(clean)
    assert len(table.vacuum(keep=2, min_age_s=0)) == 1  # what the killed run had staged
    assert rows(table) == once and len(rows(table, 1)) == 5
    table.vacuum(keep=1, min_age_s=0)
    assert rows(table) == once and os.listdir(table.path + "/_manifest") != []


def test_of_two_writers_the_second_fails(spark, table):
    stale = table.head()
    update = spark.createDataFrame(UPDATE, SCHEMA)
    table.merge(update, ["period", "k"])
    after = rows(table)
    with pytest.raises(ConflictError):
        table._commit(stale, update, stale.schema, [], None)
    assert rows(table) == after


def test_replace_and_overwrite(spark, table):
    table.replace_partitions(spark.createDataFrame([("2024-01-01", "z", "0", 3)], SCHEMA), ["2024-01-01", "2024-01-08"])
    assert {r[:2] for r in rows(table)} == {("2024-01-01", "z"), (None, "n"), ("x/y z", "s")}
    table.overwrite(spark.createDataFrame([], SCHEMA))
    assert rows(table) == [] and table.head().parts == {}


def test_columns_are_added_and_widened_but_not_narrowed(spark, table):
    wider = "period string, k string, value string, _ingested_at long, note string"
    table.merge(spark.createDataFrame([("2024-01-01", "a", "1c", 2 ** 40, "new")], wider), ["period", "k"])
    got = {(r.period, r.k): (r._ingested_at, r.note) for r in table.read().collect()}
    assert got["2024-01-01", "a"] == (2 ** 40, "new") and got["2024-01-08", "a"] == (1, None)
    with pytest.raises(SchemaChangeError, match="_ingested_at"):
        table.merge(spark.createDataFrame([("2024-01-01", "a", "1c", "late")], SCHEMA.replace("at int", "at string")), ["period", "k"])
    table.merge(spark.createDataFrame([("2024-01-08", "a", 7)], "period string, k string, _ingested_at int"), ["period", "k"])
    assert {r.value for r in table.read(values=["2024-01-08"]).collect()} == {None}


def test_reconcile_by_type(spark):
    dec = T.DecimalType
    assert widened(dec(10, 2), dec(12, 3)) == dec(12, 3) and widened(dec(10, 2), dec(10, 3)) is None
    assert widened(T.LongType(), T.IntegerType()) == T.LongType() and widened(T.LongType(), T.StringType()) is None
    assert widened(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert widened(T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())) == T.ArrayType(T.LongType())
    old = T.StructType().add("a", "integer").add("s", T.StructType().add("x", "integer"))
    new = T.StructType().add("s", T.StructType().add("x", "long").add("y", "string")).add("b", "string")
    assert reconcile(old, new).simpleString() == "struct<a:int,s:struct<x:bigint,y:string>,b:string>"
    with pytest.raises(SchemaChangeError, match="without a type"):
        reconcile(old, T.StructType().add("v", T.NullType()))
    assert conform(spark.range(1), T.StructType().add("id", "long").add("z", "date")).first() == (0, None)


def test_table_sink_reconciles(spark):
    from pricelens.sources import tables as tb
    tb.ensure_namespaces(spark)
    name = "bronze.t_reconcile"
    tb.write_table(spark.createDataFrame([(1, "a")], "k int, v string"), name, evolve=True)
    with pytest.raises(ValueError):
        tb.write_table(spark.createDataFrame([(1,)], "k long"), name)
    assert tb.write_table(spark.createDataFrame([(2 ** 40, 1.5)], "k long, w double"), name, evolve="reconcile") == 1
    assert spark.table(name).dtypes == [("k", "bigint"), ("v", "string"), ("w", "double")]
    with pytest.raises(SchemaChangeError, match="v: string to int"):
        tb.write_table(spark.createDataFrame([(1, 1)], "k long, v int"), name, evolve="reconcile")
    assert spark.table(name).count() == 1
