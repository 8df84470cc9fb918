"""End-to-end compositions: shard building, feeding batches, log report."""
