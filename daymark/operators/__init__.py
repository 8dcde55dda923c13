"""Relational operators: daily metrics, dimension joins, data-quality rules."""
