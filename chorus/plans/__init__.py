"""End-to-end jobs and the catalogue of checkable queries."""
