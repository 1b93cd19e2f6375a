"""Edge rows of the documents table that several test modules use."""

SF = "/root/testdata/sf0.001"
TEXT = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
LONG = " ".join(f"word{i % 4001}x{i % 7}" for i in range(30_000))
# (doc_id, text, lang): nulls, empty, blank, no letters, short, ties, repeated rows, copies, near copies, very long.
ROWS = [(1, None, "en"), (2, "", "en"), (3, " \t\n\x0b\x0c\r ", None), (4, "12 !! 34", "en"), (5, "Tiny text", "en"),
        (6, TEXT, "en"), (6, TEXT, "en"), (7, TEXT.upper(), "en"), (8, TEXT + " seventeen", "de"),
        (9, "quite other words that share nothing with any of the texts above at all", "de"),
        (10, LONG, "en"), (11, LONG + " end", "en"), (None, "a text without a key but with some words in it", "fr"),
        (12, "x" * 9000, "en"), (13, "a b\na b\na b\na b\na b\na b", "en"),
        (14, "héllo wörld 日本語 \U0001F600 éa " * 30, None)]
