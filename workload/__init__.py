"""The engine's operators run over the given test tables, each with its SQL counterpart."""
