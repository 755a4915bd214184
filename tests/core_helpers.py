"""Helpers of the tests outside of the text operators."""

SMALL = "/root/testdata/sf0.001"


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is not None, str(v)) for v in row])
