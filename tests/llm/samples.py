"""Small tables with every awkward row, and slow, plain versions of the operators."""

import random

import pyarrow as pa

SYLLABLES = "ba ke lo mi nu ra si to vu ze pa de go hi ju".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w.capitalize() + "." if i % 9 == 8 else w for i, w in enumerate(out))


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for i in rng.sample(range(len(words)), max(1, int(share * len(words)))):
        words[i] = "changed"
    return " ".join(words)


def awkward_texts() -> list[str | None]:
    """Null, empty, white space, no letters, short, very long, other scripts, odd spaces, equal and nearly equal texts."""
    base = [prose(i, 40 + 7 * i) for i in range(12)]
    return [
        None, "", "   ", "!!! ??? 123", "a", "one two three", "x" * 3000, prose(99, 6000), "漢字 と かな 😀 \x00\x1c\x85 ß É",
        "two  spaces\n\nand\tlines ", base[0], base[0], base[0], None, *base, *[edited(t, i, 0.01) for i, t in enumerate(base)],
        *[edited(base[3], 50 + i, 0.012) for i in range(8)], prose(3, 61) + " " + prose(500, 200), prose(500, 200),
    ]


CLASHING = {c: "clash" for c in "id key keys chunk shard bucket marks label words part cell vector host refs slots total piece".split()}


def documents(spark, texts=None):
    """Documents with the awkward texts, extra columns, a row without id and a repeated row."""
    texts = awkward_texts() if texts is None else texts
    rows = [(3 * i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3]) for i, t in enumerate(texts)]
    if rows:
        rows += [(None, "a text without id", "en", "a"), rows[-1]]
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())])
    table = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
    for name, value in CLASHING.items():
        table = table.append_column(name, pa.array([value] * len(rows), pa.string()))
    return spark.createDataFrame(table).repartition(3)


def collected(df) -> list:
    return sorted(df.collect(), key=lambda r: (r[0] is not None, r[0], str(r)))
