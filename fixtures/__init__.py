"""Test inputs and reference answers for the registered queries."""
