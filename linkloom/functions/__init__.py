"""Column functions: no DataFrame, no job, no Python UDF."""
