"""What applying snapshots reads and moves."""

from __future__ import annotations

from poolside.plans import deliveries


def test_next_results_read_the_stored_ones_once(spark):
    """Once for the results and once for the scopes; before, old rows and what new rows keep of them were read and dealt apart."""
    plan = deliveries._applied(spark, "/root/testdata/sf0.001").results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= 2 and plan.count("Join FullOuter") == 1
