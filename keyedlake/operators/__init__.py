"""Versioned-table and relational operators as DataFrame functions."""
