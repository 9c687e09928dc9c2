"""Relational operators: set algebra, graph, reports, stores."""
