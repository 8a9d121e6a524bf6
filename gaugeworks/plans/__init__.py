"""Registered queries, their table bindings and the end-to-end workflows."""
