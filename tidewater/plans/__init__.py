"""End-to-end jobs and the registry of test queries over the driver tables."""
