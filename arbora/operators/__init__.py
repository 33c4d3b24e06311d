"""Relational and tree-relational operators."""
