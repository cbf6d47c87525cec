"""Texts that are easy to get wrong."""

LONG = "über the hills and far away 1234 'tis " * 4000
TEXTS = [None, "", "  \n\t ", "a", "a b c", LONG, LONG, "Straße ñandú's 中文 \u0000 é😀", "the same text of six words", "the same text of six words", "1 2 3 !", "x" * 3000]
