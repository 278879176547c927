"""Wiring: the table model, the query registry and its SQL counterparts."""
