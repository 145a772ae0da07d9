"""Labelled-text analytics on Spark: annotated sentences in, features, taggers and scores out."""
