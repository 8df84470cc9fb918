"""DataFrame -> DataFrame operators: ordering, windows, limits, packing, feed, stats, training log."""
