"""Rows that every operator must take."""

#: Null, empty, white space only, short, repeated rows, ties and one very long text.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "One  two"), (6, "One  two"), (None, "null id text"),
       (7, "a b c " * 30_000), (8, "été \U0001F642 naïve words, here"), (9, "x" * 50_000)]
