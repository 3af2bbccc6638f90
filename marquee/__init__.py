"""Catalogue, corpus and semantic-search jobs on Spark DataFrames."""
