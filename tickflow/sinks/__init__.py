"""Writers: topic rows, NDJSON files, and the tables jobs keep."""
