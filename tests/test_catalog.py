"""Every query with SQL gives the same rows as DuckDB; the others give rows."""

import compare
import pytest

from pluvio.plans import catalog

SF = "/root/testdata/sf0.001"
CON = compare.oracle(SF)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, name):
    assert compare.difference(catalog.QUERIES[name](spark, SF), CON, catalog.SQL[name]) == ""


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_files_of_the_exchange(spark):
    rows = catalog.QUERIES["exchange_files"](spark, SF).collect()
    assert rows and all(r.content.count("\n") == 13 + r.n_observations for r in rows)


def test_whole_tables_are_read(spark):
    days = catalog.a.member_days(spark, SF).where("rainfall is not null").select("file_id").distinct().count()
    got = catalog.QUERIES["map_consensus"](spark, SF)
    assert got.select("file_id").distinct().count() == days > 0
    assert catalog.QUERIES["colour_ceiling"](spark, SF).count() == 1


def test_second_check_trains_with_its_settings(spark, monkeypatch):
    from pluvio.operators import booster, secondary

    seen = []
    monkeypatch.setattr(secondary, "train", lambda rows, **given: seen.append(given))
    monkeypatch.setattr(secondary, "score", lambda *given: None)
    catalog.QUERIES["secondary_scores"](spark, SF)
    assert seen == [{"settings": booster.Settings(trees=40, depth=5, rate=0.1)}]
