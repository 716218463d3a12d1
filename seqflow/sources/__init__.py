"""Sources and sinks: tables, JSON payload rows, positional CSV folders, fixture mappings."""
