"""Bronze, silver and gold refreshes over stored tables."""
