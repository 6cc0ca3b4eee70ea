"""DataFrame-in, DataFrame-out steps of the pipeline."""
