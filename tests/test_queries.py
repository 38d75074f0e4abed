"""Every registered query against its SQL check on the smallest tables."""

import pytest

from larkspur.registry import callables, check_sql
from tests.compare import compare_one, open_tables

FNS, SQLS = callables(), check_sql()
ROWS_ONLY = {"aggf_approx", "row_hash_number", "list_files", "random_columns", "ml_split", "ml_train_score"}


@pytest.fixture(scope="module")
def con(small):
    return open_tables(small)


@pytest.mark.parametrize("key", list(FNS))
def test_query(spark, con, small, key):
    made = []

    def build(session, folder):
        made.append(FNS[key](session, folder))
        return made[0]

    problem, rows = compare_one(spark, con, build, SQLS.get(key), small)
    assert problem is None
    assert rows >= 0
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rows_only_list_is_exact():
    assert set(FNS) - set(SQLS) == ROWS_ONLY
