"""Column-level building blocks: week keys, guarded ratios, labels, order statistics."""
