"""Documents with the awkward cases that every operator must handle, and texts to plant in them."""

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, fp STRING, size STRING, Body STRING, id INT"


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def documents(seed=1, n=40):
    """Rows of SCHEMA: ordinary, near copies, repeated rows, null and empty texts, null ids, one long text; extra columns clash."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöü") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    texts = [sentence(rng, rng.randint(1, 300), words) for _ in range(n)]
    near = texts[0].split(" ") * 3
    texts += [" ".join(near), " ".join([*near[:-1], "other"]), " ".join(["Other", *near[1:]])]
    texts += [texts[1], texts[1], None, None, "", "   \t\n", "one", "one two", "Two\x0bWORDS", "ünï çödé 日本語 " * 3, "a " * 3000, sentence(rng, 6000, words)]
    rows = []
    for i, text in enumerate(texts):
        lang = rng.choice(["en", "de", None])
        rows.append((i * 3, text, lang, rng.choice(["s1", "s2", "ß", None]), None, "x", "y", "z", 1))
    rows += [rows[0], rows[0], (None, "null id", "en", "s1", 1, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows
