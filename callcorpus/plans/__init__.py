"""End-to-end jobs (``jobs``), inputs derived from the driver tables (``derived``) and the
driver-facing query registry with DuckDB oracles (``queries``)."""
