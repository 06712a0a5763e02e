"""Spark jobs that prepare text corpora and analyse the runs that consume them."""
