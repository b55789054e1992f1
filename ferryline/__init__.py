"""Warehouse feeds, loads, distribution checks and object inventories on Spark."""
