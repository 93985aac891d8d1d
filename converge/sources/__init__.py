"""Sources: change records to canonical events, and configuration and log files."""
