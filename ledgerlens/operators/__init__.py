"""Row-level operators: cleaning, features, pair aggregation and quality checks."""
