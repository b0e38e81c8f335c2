"""The registered queries, the entities they read and their SQL checks."""
