"""Warehouse table checks, conforming and movement on Spark."""
