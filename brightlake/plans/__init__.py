"""Table-level plans: gold aggregates, SQL models, features, ML, served queries."""
