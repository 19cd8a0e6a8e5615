"""Relational building blocks: change capture, attributes, properties, batching."""
