"""Query plans: named building blocks, the query registry and oracles."""
