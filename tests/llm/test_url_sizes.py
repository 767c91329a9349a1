"""The URL filter stands before the exact join whatever its size."""

import pytest
from pyspark.sql import functions as F

from sectorlens.llm import urls


@pytest.mark.parametrize("most", [0, urls.BROADCAST_BLOCKS])
def test_a_filter_of_any_size_is_used(spark, most):
    keys = spark.range(3000).select(F.concat(F.lit("host"), "id").alias("canonical"))
    listing = keys.where("canonical LIKE '%7'").unionAll(keys.limit(5))
    found = urls.listed(keys.unionAll(keys), [], "canonical", listing, broadcast_blocks=most)
    assert "w3" in found._jdf.queryExecution().optimizedPlan().toString()
    want = sorted(r.canonical for r in listing.distinct().collect() for _ in range(2))
    assert sorted(r.canonical for r in found.collect()) == want
