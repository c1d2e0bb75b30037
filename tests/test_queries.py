import pytest

from docquarry.plans import queries
from tests.compare import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, con, name):
    assert same(queries.QUERIES[name](spark, SF), con, queries.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_without_sql_has_rows(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.schema == queries.QUERIES[name](spark, SF).schema and df.count() > 0


def test_streamed_import_equals_batch_import(spark):
    batch = queries.QUERIES["import_first_wins"](spark, SF)
    streamed = queries.QUERIES["stream_import"](spark, SF)
    # The batch query has verdicts from before for every fiftieth document; and the second file's records come in no order here.
    key = lambda df: {(r.result_id, r.category_id) for r in df.where("result_id % 50 <> 0").collect()}
    assert key(streamed) == key(batch)


def test_entry_point():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
