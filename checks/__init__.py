"""The queries by which the package is checked, each with its SQL counterpart."""
