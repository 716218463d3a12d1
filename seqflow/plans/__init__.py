"""Jobs composed from operators: ingest, prepare, features, sequences, model."""
