"""Query plans: role tables, the warehouse, the questions, cleaning and model
flows, and the registry of query keys."""
