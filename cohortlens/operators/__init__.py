"""Relational and statistical operators composed from DataFrame primitives."""
