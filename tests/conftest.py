import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session

    s = local_session(4, 8, app="quarry-tests")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"


def plain_words(text):
    """Words of a text, found character by character: ASCII marks and white space end a word."""
    words, current = [], []
    for ch in text + " ":
        is_mark = ch.isascii() and ch.isprintable() and not ch.isalnum() and ch != " "
        if is_mark or ch.isspace():
            if current:
                words.append("".join(current).lower())
            current = []
        else:
            current.append(ch)
    return words
