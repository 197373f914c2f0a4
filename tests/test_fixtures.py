"""Inputs derived from the test tables."""

from billflow import fixtures as X


def test_orders_move_before_their_texts_are_made(spark, sf_dir):
    """One task reads a small file; what it hands on are the four columns of the table, and bills are made behind."""
    made = X.model_outputs(spark, sf_dir)["m_a"]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "date_format" in plan and "date_format" not in below and "concat" not in below
    spread, plain = (X.bills(spark, sf_dir, spread=s) for s in (True, False))
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, plain.collect()))
