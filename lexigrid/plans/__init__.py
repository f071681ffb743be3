"""Whole jobs composed from the operators: index build, registered queries, oracles."""
