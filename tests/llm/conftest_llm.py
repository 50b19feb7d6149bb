"""Small corpora shared by the tests of this folder."""

import random

DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, size string, "
        "class string, label string, node string, host string, text_hash string, shard string")
CLASHING = ("x",) * 7
SYLLABLES = "ba de ki lo mu ré ñu tz ei on th an".split()


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    text = " ".join(words(rng, n)) + "."
    return text[:n * 2].replace(" ", "\n", 1) + text[n * 2:]


def near_copy(rng: random.Random, text: str, changes: int) -> str:
    parts = text.split(" ")
    for k in rng.sample(range(len(parts)), min(changes, len(parts))):
        parts[k] = "changed"
    return " ".join(parts)


def document_rows(seed: int = 5, n: int = 120) -> list[tuple]:
    """(doc_id, text) with exact and near copies, marks, digits and personal data."""
    rng = random.Random(seed)
    texts: list = []
    for k in range(n):
        kind = k % 12
        if kind == 3 and texts:
            texts.append(rng.choice(texts))
        elif kind in (4, 5) and texts:
            texts.append(near_copy(rng, rng.choice(texts), rng.randint(0, 4)))
        elif kind == 6:
            texts.append(prose(rng, 30) + f" mail me@host{k}.example.org or +1 (555) 123-45{k:02d}"
                         f" from 10.0.{k}.7, 4111 1111 1111 1111 &&& It's {k} ½²")
        else:
            texts.append(prose(rng, rng.randint(1, 120)))
    return list(enumerate(texts))


ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (None, "two words"),
       (None, None), (5, "Ünïcode 漢字 ́ \U0001f600 İ <|endoftext|>"), (6, "a b c d e " * 6000),
       (6, "a b c d e " * 6000), (7, "\x00\x1c\x85 control \x0b x@y.z"), (-8, "same text here ok"),
       (9, "same text here ok"), (10, "9" * 5000 + "@" * 50 + "." * 50)]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en" if k % 3 else None, f"src{k % 4}" if k % 5 else None,
          None if t is None else len(t), *CLASHING) for k, (i, t) in enumerate(rows)], DOCS)
