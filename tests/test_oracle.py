"""Every registered core query against its SQL."""

import pytest
from oracle import connect, duck_table, spark_table

from tideline import queries as Q

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(MID)


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, duck, name):
    got = spark_table(Q.queries()[name](spark, MID))
    assert got[1], "no rows"
    if name in Q.oracle_sql():
        want = duck_table(duck, Q.oracle_sql()[name])
        assert got[0] == want[0]
        assert len(got[1]) == len(want[1])
        assert got[1] == want[1]
