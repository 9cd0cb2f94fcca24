"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import pytest

from tests.conftest import SF_SMALL


def _keys():
    import __spark_entry__ as E
    return sorted(E.queries())


@pytest.fixture(scope="module")
def duck():
    from tools.oracle_check import duck as make
    return make(SF_SMALL)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E
    from tools.oracle_check import rows_of
    sdf = E.queries()[key](spark, SF_SMALL).toPandas()
    orc = E.oracle_sql().get(key)
    if orc is None:
        assert len(sdf.columns) > 0
        return
    ddf = duck.execute(orc).df()
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["car_type_id", "category", "subcategory_name", "sub_category", "group_id", "articles"]
