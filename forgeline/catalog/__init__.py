"""Registered queries, grouped by area; see forgeline.registry."""
