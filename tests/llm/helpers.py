"""Brute-force versions of what the operators compute, on small inputs."""

import re

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and then it sleeps for a while."),
    (2, "The quick  brown fox jumps over the lazy dog\nand then it sleeps for a while."),
    (3, ""),
    (4, None),
    (5, "word"),
    (6, "  \t\n "),
    (7, "The quick brown fox jumps over the lazy dog and then it sleeps for a while."),
    (7, "The quick brown fox jumps over the lazy dog and then it sleeps for a while."),
    (None, "A row without a number."),
    (9, "é ü ñ ☃ 😀 " * 40),
    (10, "x" * 5000),
    (11, "long text " * 3000),
]
#: Columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, key string, sha string, component string, _gone int"


def table(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "en", "s", 1, "k", "s", "c", 0) for i, t in rows], SCHEMA)


def shingles(text, size=5):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def components(ids, links):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least
