"""Relational and spatial operators over DataFrames."""
