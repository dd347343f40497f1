"""Readers (files, tables, star schema, synthetic rows) and writers."""
