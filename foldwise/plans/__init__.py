"""End-to-end runs, the report tables and the registered queries."""
