"""Registered queries: the operators over log feeds derived from the test tables, with their SQL."""
