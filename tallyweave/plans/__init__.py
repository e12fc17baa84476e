"""Whole chains of operators, each one lazy plan."""
