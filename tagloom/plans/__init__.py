"""Compositions: fixture views, whole runs and the registered queries."""
