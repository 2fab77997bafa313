"""End-to-end plans: the pipeline, the hyper-parameter search, the query registry and its SQL oracles."""
