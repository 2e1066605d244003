"""DataFrame operators: features, split, evaluation, curves, neighbours, explain."""
