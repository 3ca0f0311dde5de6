"""Plain checkers for the operator tests."""

import re


def card_digits(text):
    return re.sub(r"[^0-9]", "", text)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def smallest_reachable(ids, links):
    """Component of every id, as its smallest member."""
    label = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                moved = True
    return label
