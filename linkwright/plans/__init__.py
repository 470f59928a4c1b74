"""Composed plans: test entities, the rule solver, the trained resolver."""
