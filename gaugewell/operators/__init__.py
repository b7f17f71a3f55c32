"""DataFrame building blocks: cells, scalar metrics, ranked values, pilot sample."""
