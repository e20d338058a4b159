"""DataFrame operators: DataFrame in, DataFrame out; only validate.enforce() and functions that say so run a job."""
