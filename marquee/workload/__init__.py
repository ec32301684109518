"""The operators as named queries over the given tables, with equivalent SQL."""
