"""DataFrame-in, DataFrame-out operators over samples."""
