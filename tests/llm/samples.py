"""Rows that every operator must take."""

# Nulls, empty and blank texts, very long ones, ties and repeated rows.
ODD = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "word"), (5, "a b c d"), (6, "a b c d"), (6, "a b c d"), (None, "x y z x y z"),
       (None, None), (7, "long " * 60_000), (8, "z" * 100_000), (9, "Ünïcödé … 三十 🙂 İ ß"), (10, "\0\x1c\x85"), (11, "A B C D")]
