"""The registered queries: each takes a session and a folder with the given tables."""
