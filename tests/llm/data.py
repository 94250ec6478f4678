"""Documents with everything that may go wrong, and groups of near copies."""

from __future__ import annotations

import random

# Columns that operators use inside or return.
CLASHES = ["n_words", "size", "kept", "key", "row", "k", "class", "node", "shard", "copies", "spans", "id", "text_crc32"]

VOCABULARY = [f"w{i}" for i in range(400)] + ["the", "of", "and", "mail@host.example.com", "Ünï", "日本", "x|y"]


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def near_copies(seed, groups=6, copies=12, words=80):
    """Texts in groups with a few words changed, of which some are similar enough."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = sentence(rng, words).split()
        for _ in range(copies):
            changed = list(base)
            for _ in range(rng.randrange(0, 4)):
                changed[rng.randrange(len(changed))] = rng.choice(VOCABULARY)
            if rng.random() < 0.2:
                del changed[: rng.randrange(1, 8)]
            texts.append(" ".join(changed))
    rng.shuffle(texts)
    return texts


def edge_rows():
    """(doc_id, text, source): NULLs, blanks, ties, repeated rows, copies, a long text, shared passages."""
    rng = random.Random(3)
    passage = sentence(rng, 30)
    long = sentence(rng, 30_000)
    texts = near_copies(5, 3, 5)
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b ", None), (4, "one", "b"), (5, "one two three", "b"),
        (6, long, "c"), (7, passage, "c"), (8, passage, "c"), (9, "x " + passage + " y", None),
        (10, passage.upper(), "a"), (10, passage.upper(), "a"), (11, "Zz\n" + passage + "\n" + passage, "a"),
        (12, "a b\na b\na b\n c", "b"), (None, passage + " tail", "b"), (None, "alone here", None),
        (13, "#" * 50 + " " + "9" * 5000 + " +1 (234) 567-8901 a.b@c.de 1.2.3.4, 4111 1111 1111 1111", "b"),
    ]
    rows += [(20 + i, t, rng.choice(["a", "b", "c", None])) for i, t in enumerate(texts)]
    rows += [(60 + i, "w1 w2 " * 20 + str(i // 2), "d") for i in range(6)]
    return rows


def documents(spark, rows):
    schema = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHES
    )
    full = [(d, t, s, "en" if s else None, None, *CLASHES) for d, t, s in rows]
    return spark.createDataFrame(full, schema)
