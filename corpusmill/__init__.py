"""Preparing text corpora on Spark: filtering, mixing and tokenizing documents as DataFrame transformations."""
