"""Registered queries against their SQL twins, on whole small tables."""

import pytest

from moodtide.llm import queries
from tests.conftest import plan_of


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, duck, folder, name):
    result = queries.QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    cursor = duck.execute(queries.ORACLE[name])
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(at) == columns
    expected = sorted((tuple(r[at[c]] for c in columns) for r in cursor.fetchall()), key=repr)
    assert expected and sorted((tuple(r) for r in result.select(*columns).collect()), key=repr) == expected


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_line_templates", "op2_chat_examples", "op9_benchmark_leaks"])
def test_native_operators_run_no_python(spark, folder, name):
    plan = plan_of(queries.QUERIES[name](spark, folder))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
