"""The plan that a query really ran with."""


def executed_plan(df) -> str:
    """The physical plan after running the query."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
