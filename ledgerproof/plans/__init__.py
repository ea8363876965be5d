"""Reports, load jobs and the queries built from the operators."""
