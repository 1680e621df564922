"""The supplied tables seen as posts, the registered queries, and their SQL counterparts."""
