"""DataFrame-in, DataFrame-out operators over documents, postings and run logs."""
