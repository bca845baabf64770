"""Operations for preparing training text, each also registered as a named query."""
