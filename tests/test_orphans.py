"""The orphan check is compared on data that holds orphans."""

import pytest
from querybook.fixtures import Inputs
from querybook.quality import orphans_of_some_departments


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_some_departments_are_missing(spark, scale):
    rows = orphans_of_some_departments(Inputs(spark, f"/root/testdata/{scale}")).collect()
    assert rows and all(r["n"] > 0 for r in rows)
