"""DataFrame operators: features, splits, models, metrics, reports."""
