def value(spark, column, **inputs):
    """Evaluate a column over one row of the given inputs."""
    schema = inputs.pop("schema")
    row = spark.createDataFrame([tuple(inputs.values())], schema)
    return row.select(column.alias("out")).first()["out"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

