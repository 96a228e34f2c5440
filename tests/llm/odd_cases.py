"""Rows every operator has to take."""

# Cases every operator has to take: NULL and empty texts, blanks, ties, repeated rows and ids, NULL ids, odd bytes.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t\n  "),
    (4, "One line that repeats in other documents\nand a second line of this one"),
    (4, "One line that repeats in other documents\nand a second line of this one"),
    (4, "Another text under the same id\nONE LINE that repeats in other documents  "),
    (5, "ONE LINE THAT REPEATS IN OTHER DOCUMENTS \n\nshort\nshort\n"),
    (6, "\x00\x00 zero bytes \x00 and é ñ ß 漢字 letters\x00\x00" + "\x00" * 60),
    (7, "\x00\x00 zero bytes \x00 and é ñ ß 漢字 letters\x00\x00" + "\x00" * 61),
    (8, "a" * 700),
    (9, "b" + "a" * 300),
    (10, "word " * 3000),
    (-3, "One line that repeats in other documents"),
    (None, "One line that repeats in other documents\nof a row without id"),
    (None, None),
]
