"""Gazette publications as Spark DataFrames: listings in, a keyed lake of publications out."""
