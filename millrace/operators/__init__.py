"""Relational, aggregate, feature and model operators over DataFrames."""
