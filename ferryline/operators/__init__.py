"""Operators over DataFrames: loads, distribution checks, inventories, previews, run logs."""
