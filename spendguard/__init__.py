"""Spark jobs over logs of AI model calls: usage, cost, budgets, sessions, content and rates."""
