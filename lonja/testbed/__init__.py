"""The benchmark tables dressed up as raw shop data, the registered queries over them, and their SQL counterparts."""
