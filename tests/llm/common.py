"""Small documents with every awkward case, and helpers."""

import random
import re

SCHEMA = "doc_id long, text string, source string, key string, n_bytes long, bucket int, tokens string, component string"
TOKENIZER_WORDS = re.compile("[^\x20\x09-\x0D]+")


def awkward() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    words = [f"w{i}é" for i in range(400)]
    base = [rng.choice(words) for _ in range(150)]
    docs: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "ONE"), (6, "a b c d"), (7, "a  b\nc d e"), (8, "x" * 250), (9, "ab" * 180),
        (10, "́\u0085 \x1c tab\tnul\x00 <|endoftext|> end"), (11, "The quick brown fox. " * 30), (12, "ünï çödé " * 40),
    ]
    for i in range(40):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        docs.append((100 + i, " ".join(copy[rng.randrange(4) :])))
    docs += [(200 + i, " ".join(base)) for i in range(6)]
    docs += [(300 + i, " ".join([*(rng.choice(words) for _ in range(60)), *base[20:60], *(rng.choice(words) for _ in range(i))])) for i in range(12)]
    docs.append((400, " ".join(rng.choice(words) for _ in range(30_000))))
    return docs


def frame(spark, docs, parts: int = 4):
    """With further columns whose names clash with the operators' own."""
    rows = [(k, t, "s", "k", 5, 1, "t", "c") for k, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
