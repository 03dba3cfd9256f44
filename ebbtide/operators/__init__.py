"""DataFrame-to-DataFrame operators of the churn pipeline."""
