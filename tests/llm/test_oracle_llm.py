import pytest

import __spark_entry__
from tests.helpers import duck_rows, spark_rows


@pytest.mark.parametrize("key", sorted(k for k in __spark_entry__.oracle_sql() if k.startswith("op") and k[2].isdigit()))
def test_oracle(spark, duck, key):
    d = "/root/testdata/sf0.001"
    assert spark_rows(__spark_entry__.queries()[key](spark, d)) == duck_rows(duck(d), __spark_entry__.oracle_sql()[key])
