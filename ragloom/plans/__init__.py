"""Derived inputs, registered queries, oracles and end-to-end runs."""
