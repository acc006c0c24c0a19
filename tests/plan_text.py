"""Text of physical plans, for tests that look into them."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
