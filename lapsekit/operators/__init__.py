"""DataFrame operators of the activity / churn model."""
