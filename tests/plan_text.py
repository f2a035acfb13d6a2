"""Text of a plan, for tests that look for scans, shuffles and filters."""


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
