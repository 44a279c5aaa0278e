"""Spark operators for registers that are republished without a record key."""
