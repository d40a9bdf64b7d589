"""DataFrame operators: analytics, DAG, incremental state and upsert, run-log folds,
SQL templating, sinks and Python function steps."""
