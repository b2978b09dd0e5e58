"""The given tables mapped onto the air-traffic domain, queries over them, and oracles."""
