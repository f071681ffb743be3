"""Spark-native text retrieval: postings tables, Boolean, phrase and ranked queries."""
