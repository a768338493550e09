"""Rows as a bag, columns in the order of their names."""

from collections import Counter


def bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows)
