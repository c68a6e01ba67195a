"""Rows that every operator has to survive."""

#: Null, empty, blank, no letter, one word, odd characters, repeated rows, equal texts under
#: other keys, missing keys, long words.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "12 345 !!"), (5, "word"), (6, "a\x00b ﬀ İ ſ K 😀"),
       (7, "same text here"), (7, "same text here"), (8, "same text here"), (None, "no key at all"),
       (None, None), (9, "x" * 5000 + " y" * 3000)]
