"""DataFrame -> DataFrame operators: preparation, features, sequences, scaling, metrics, run logs, state."""
