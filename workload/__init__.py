"""The package's operators as queries over the given tables, with their SQL counterparts."""
