"""Every core query that has an oracle, against DuckDB."""

import pytest

from checks.compare import compare
from checks.oracle import ORACLES
from checks.queries import QUERIES


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_matches_oracle(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name).startswith("ok")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
