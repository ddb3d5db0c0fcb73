"""The registered queries: inputs from the given tables, Spark queries, DuckDB SQL."""
