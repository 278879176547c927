"""Procurement and supplier analytics as lazy Spark DataFrame functions."""
