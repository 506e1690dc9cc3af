import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from lakeread.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402
from oracle import compare  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), ORACLE_SQL[name], SF) > 0
