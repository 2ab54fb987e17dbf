"""The queries run over the star-schema tables, and the same queries as plain SQL."""
