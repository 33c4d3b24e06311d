"""Column functions: identifiers, text, predicates, statistics."""
