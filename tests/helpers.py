from datetime import datetime


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*(cols or df.columns)).collect()
    return sorted((tuple(r) for r in picked), key=repr)


def ts(text):
    return datetime.fromisoformat(text)
