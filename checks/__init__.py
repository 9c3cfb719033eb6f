"""Test views derived from the provided tables, the query registry and its oracles."""
