"""Reusable relational operators, free of any particular table."""
