"""Column expressions; every one stays inside Catalyst (no Python UDFs)."""
