"""Relational operators built from DataFrame / SQL primitives."""
