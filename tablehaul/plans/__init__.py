"""SQL scripts and the registered queries."""
