"""DataFrame-in, DataFrame-out operators; all of them lazy."""
