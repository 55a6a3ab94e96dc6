"""Small tables with everything that a documents table may hold."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, "
    # Names that the operators use inside.
    "ids BINARY, start BIGINT, words BIGINT, size BIGINT, item STRING, shard INT, score DOUBLE"
)

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))


def rows(seed: int = 0) -> list[tuple]:
    """(doc_id, text): nulls, empty and very long texts, ties, near copies, repeats."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Éa", "straße", "a,", "b.", "x", "12", "#", "don't", "tion"]
    vocabulary += [f"{a}{b}" for a in ("er", "on", "th", "in") for b in ("es", "an", "ou", "ea")]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    text = lambda n: "\n".join(line(rng.randint(1, 14)) for _ in range(n))
    texts: list[str | None] = [None, "", " ", "\n\n", "one", LONG, "<|endoftext|> x", "\t a  b\n c"]
    for _ in range(30):
        whole = text(rng.randint(1, 30))
        texts.append(whole)
        kind = rng.random()
        if kind < 0.25:
            texts.append(whole)
        elif kind < 0.6:
            words = whole.split(" ")
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind < 0.8:
            texts.append(text(3) + "\n" + whole[len(whole) // 2 :])
    return list(enumerate(texts))


def docs(spark, data: list[tuple]):
    """The rows with extra columns, dealt over several partitions."""
    full = [(i, t, "en", "src0", len(t or ""), b"x", 7, 7, 7, "i", 7, 0.5) for i, t in data]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def table_folder(tmp_path, spark, **tables) -> str:
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
