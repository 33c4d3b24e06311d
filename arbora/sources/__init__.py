"""Readers of tabular, sequence, interval, ontology and tree inputs."""
