"""Pedigree analytics on Spark: records in, one deduplicated animal graph and its queries out."""
