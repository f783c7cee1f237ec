"""Whole tables, each a function of other tables."""
