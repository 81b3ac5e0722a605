"""Rows that every operator has to stand."""

# Null ids and texts, empty and blank texts, ties and repeated rows.
ODD = [(1, None), (None, "only an id is missing here"), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (4, "other"), (5, "x" * 40_000)]
