"""Plain restatements of the definitions, to test against."""

import string


def ascii_lower(text):
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
