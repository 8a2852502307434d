"""Documents for tests, with extra columns named as operators name their own."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, mark long, kept string, fingerprint string,"
    " k1 long, spans string, bin_id string, row string, own string, page_id long, url string, score double"
)

PROSE = (
    "The river runs past the old mill and under two bridges. In spring the meadow floods, and the path is closed"
    " until the water falls. Children come to look for shells that nobody else would call shells.\n"
    "A heron stands there on most mornings. It does not mind the boats, which are few, nor the dogs, which are many.\n"
    "Further down the banks grow steep and the trees meet over the water, so that even at noon it is dark and cool."
)


def table(spark, rows):
    """Documents with extra columns, named as operators name their own. ``rows``: id and text."""
    full = [
        (i, t, "en", f"src{(i or 0) % 3}", len(t or ""), 7, "x", "y", 8, "z", "b", "r", "o", 9, "u", 0.5) for i, t in rows
    ]
    return spark.createDataFrame(full, SCHEMA)
