import random

from conform.llm.components import connected_components


def roots(spark, edges):
    return {r[0]: r[1] for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}


def test_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1000 + i, 999) for i in range(1, 80)]
    ids = list(range(200, 260))
    random.Random(2).shuffle(ids)
    mixed = list(zip(ids, ids[1:]))
    got = roots(spark, path + star + mixed + [(5, 5), (7, 6), (6, 7)])
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[1000 + i] for i in range(1, 80)} | {got[999]} == {999}
    assert {got[i] for i in range(200, 260)} == {200}
    assert got[7] == got[6] == 6 and 5 not in got


def test_no_edges(spark):
    assert roots(spark, []) == {}
