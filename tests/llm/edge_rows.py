"""Rows with nulls, empty and very long texts, repeats, and column names that may clash."""

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000)) + " token = 'abcdefgh12345678'"
TEXTS = [(1, "The quick brown fox and the lazy dog are in the house of the man, it is said."),
         (2, None), (3, ""), (4, " \t\n\x0b\r "), (5, LONG), (6, LONG),
         (None, "a row without id"), (None, None), (None, "a row without id"),
         (7, "same"), (7, "same"), (7, "another text of the same id"),
         (8, "naïve café 漢字 \U0001f600 ﬁ x   y"), (9, "x" * 5000), (10, "a\n\na\n\n a\nb")]
#: Names that the operators use inside or return.
CLASHES = "n_words text_hash fp row k key t i h z m v found kinds hits hit_items mean top score ids kept start ends".split()
