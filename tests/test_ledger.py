import os

import pytest
from pyspark.sql import functions as F

from pricelens.config import Config
from pricelens.operators import series
from pricelens.plans import refresh
from pricelens.plans.ledger import Step, StepLedger, content_version
from pricelens.plans.refresh import RefreshInputs, refresh_all
from pricelens.sources import adapter
from pricelens.sources import tables as tb

from conftest import SF_SMALL


def test_version_follows_rows_not_their_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    assert content_version(a) == content_version(a.orderBy(F.desc("k")).repartition(3))
    assert content_version(a) != content_version(a.distinct())
    assert content_version(a) != content_version(a.withColumn("v", F.coalesce("v", F.lit(""))))
    assert content_version(a.limit(0)) == content_version(a.limit(0).repartition(2))


class Runs:
    """Steps a -> b -> c and d, which note that they ran; some fail half-way."""

    def __init__(self, spark):
        self.spark, self.ran, self.failing, self.value = spark, [], set(), 0
        spark.sql("CREATE DATABASE IF NOT EXISTS ledger_t")

    def step(self, name, after, parameters=""):
        def run():
            self.ran.append(name)
            tb.write_table(self.spark.range(1).select(F.lit(self.value).alias("v")), f"ledger_t.{name}", evolve=True)
            if name in self.failing:
                raise RuntimeError(f"{name} died")
            return 1
        return Step(name, f"ledger_t.{name}", after, run, parameters)

    def go(self, folder, version, parameters=""):
        self.ran.clear()
        steps = [self.step("a", ("in",)), self.step("b", ("a",)), self.step("c", ("b",), parameters),
                 self.step("d", ("other",))]
        StepLedger(self.spark, folder).run(steps, {"in": version, "other": "same"})
        return list(self.ran)


def test_ledger_resumes_and_restarts(spark, tmp_dir):
    runs, folder = Runs(spark), os.path.join(tmp_dir, "ledger")
    runs.failing = {"b"}
    with pytest.raises(RuntimeError):
        runs.go(folder, "v1")
    runs.failing = set()
    assert runs.go(folder, "v1") == ["b", "c", "d"]      # goes on at the step that failed
    assert runs.go(folder, "v1") == []
    assert runs.go(folder, "v1", "other model") == ["c"]  # a parameter of one step
    assert runs.go(folder, "v2", "other model") == ["a", "b", "c"]
    spark.sql("DROP TABLE ledger_t.b")
    assert runs.go(folder, "v2", "other model") == ["b"]


def test_half_written_step_does_not_pass_for_an_older_one(spark, tmp_dir):
    runs, folder = Runs(spark), os.path.join(tmp_dir, "half")
    runs.value = 1
    runs.go(folder, "v1")
    runs.value, runs.failing = 2, {"a"}
    with pytest.raises(RuntimeError):
        runs.go(folder, "v2")                             # wrote its table, then died
    runs.value, runs.failing = 1, set()
    assert runs.go(folder, "v1")[0] == "a"                # back to the first input: done again
    assert spark.table("ledger_t.a").first().v == 1


def test_refresh_goes_on_at_gold(spark, tmp_dir, monkeypatch):
    cfg, folder = Config(catalog="t_resume"), os.path.join(tmp_dir, "refresh")
    inputs = RefreshInputs(records=adapter.price_records(spark, SF_SMALL), zones=adapter.delivery_zones(spark, SF_SMALL))
    written, write = [], tb.write_table

    def noted(df, name, **options):
        written.append(name.split(".")[1])
        return write(df, name, **options)

    def broken(*_):
        raise RuntimeError("no regional table today")
    monkeypatch.setattr(refresh.tb, "write_table", noted)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(series, "regional_comparison", broken)
        refresh_all(spark, inputs, cfg, "2026-01-01", "linear_seasonal", ledger=folder)
    assert written == ["fuel_prices_raw", "fuel_prices", "weekly_fuel_summary"]
    written.clear()
    counts = refresh_all(spark, inputs, cfg, "2026-01-01", "linear_seasonal", ledger=folder)
    assert written == ["regional_comparison", "fuel_price_forecast", "delivery_zones", "surcharge_config"]
    assert all(v > 0 for v in counts.values()) and len(counts) == 7
    written.clear()
    fewer = RefreshInputs(records=inputs.records, zones=inputs.zones.filter("duoarea <> 'Z000001'").limit(20))
    refresh_all(spark, fewer, cfg, "2026-01-01", "linear_seasonal", ledger=folder)
    assert written == ["delivery_zones"]                  # only what follows from the zones
