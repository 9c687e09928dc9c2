"""End-to-end plans: build, search, evaluate."""
