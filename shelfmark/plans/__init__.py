"""The normalised store and the registered queries with their SQL counterparts."""
