import pytest

import __spark_entry__ as entry
from conform.llm.queries import ORACLE, QUERIES
from tools.compare import canon, duck

SF = "/root/testdata/sf0.001"


def test_one_query_an_operator_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    got = QUERIES[name](spark, SF)
    want = duck(SF).execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == canon(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[:4] in ("op6_", "op10")))
def test_native_queries_run_no_python(spark, name, capsys):
    QUERIES[name](spark, SF).explain("formatted")
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan and "Pandas" not in plan


