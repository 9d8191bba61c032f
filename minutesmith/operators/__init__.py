"""Relational operators over meetings and speeches."""
