"""How keyed, ordered work is laid out over partitions."""
