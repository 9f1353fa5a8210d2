"""Every registered query of the engine against its DuckDB oracle (the driver's gate) on sf0.001.

The text queries have tests of their own beside them; not all of them can be stated in SQL."""

import pytest
from compare import compare
from conftest import SF_SMALL

import __spark_entry__ as entry
from activitykit.plans.registry import registry
from oracle_sql import oracle


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle())
    assert set(registry()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["week_start_kst", "weekly_active_sessions"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert "error" not in res, res
    assert res["cols_match"] and res["rows_match"] and res["values_match"], res


@pytest.mark.parametrize("name", ["wau_users", "duplicate_metrics", "dlq_ratio", "quality_gate", "stage_counts"])
def test_result_types_match(spark, name):
    from compare import duck

    names = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "date": "DATE"}
    spark_types = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in entry.queries()[name](spark, SF_SMALL).schema.fields}
    rel = duck(SF_SMALL).sql(entry.oracle_sql()[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
