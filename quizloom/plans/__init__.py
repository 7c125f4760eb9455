"""Workflows that join the operators, and the driver queries with their SQL."""
