"""Sources (raw snapshots, product seed, stored layers) and sinks."""
