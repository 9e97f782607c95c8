"""DataFrame operators: (df, ...) -> df."""
