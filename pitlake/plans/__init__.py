"""Dataflows of several operators, and the registered queries."""
