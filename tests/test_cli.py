import pytest

from pricelens.__main__ import main
from pricelens.sources import pages as pg

from conftest import SF_SMALL


def test_cli_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out.split()
    assert "weekly_summary" in out and "delivery_margins" in out


def test_cli_query(spark, capsys):
    assert main(["query", "products", "--sf-dir", SF_SMALL, "--show", "5"]) == 0
    assert "Regular Gasoline" in capsys.readouterr().out


def test_incomplete_pages_fail(spark):
    full = spark.createDataFrame(
        [(("3", [tuple(["2024-01-01", "NUS", "U.S.", "EPMR", "n", "p", "s", "d", "1.0", "u"])]),)],
        pg.PAGE_SCHEMA)
    with pytest.raises(ValueError, match="incomplete"):
        pg.require_complete(full)
    ok = spark.createDataFrame(
        [(("1", [tuple(["2024-01-01", "NUS", "U.S.", "EPMR", "n", "p", "s", "d", "1.0", "u"])]),)],
        pg.PAGE_SCHEMA)
    assert pg.require_complete(ok)["missing"] == 0
