"""Rows that every operator on documents has a defined result for."""

EDGE = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a"), (4, "a"), (5, "Same Text here"), (6, "same text HERE"),
    (7, "é" * 3000 + " ü"), (8, "word " * 30_000), (None, "no id"), (None, None),
]
