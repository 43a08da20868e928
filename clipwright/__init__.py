"""Clipwright: curation of speech and text corpora as PySpark DataFrame transformations."""
