"""Corpus preparation and unigram language-model classification as Spark DataFrame jobs."""
