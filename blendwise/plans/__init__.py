"""Report models (``reports``), driver-table roles and the query registry."""
