import random

import pytest

SCHEMA = "doc_id long, text string, _text string, _row long, quality int, n_tokens long"

WORDS = "the of and to in is that for with as on was be by at from this it an or".split()


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return [rng.choice(WORDS) + str(rng.randrange(40)) if rng.random() < 0.6 else rng.choice(WORDS) for _ in range(n)]


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, very long ones, copies, near copies, repeated ids and rows, odd characters."""
    base = words(1, 120)
    near = base[:60] + ["changed"] + base[61:]
    chain = near[:20] + ["other"] + near[21:]
    long = " ".join(words(2, 30_000))
    rows = [
        (1, " ".join(base)),
        (2, " ".join(near)),
        (3, " ".join(chain)),
        (4, " ".join(base).upper()),
        (5, None),
        (6, ""),
        (7, " \t\n\x0b\x0c\r "),
        (8, "one two"),
        (9, "ONE  two"),
        (10, long),
        (11, long + " and more"),
        (12, "é" * 300 + " Ünïcode “quotes” 日本語 " + "x" * 5000),
        (13, "a b c d e f g"),
        (14, "don't 'll we'd <|endoftext|> <s> </s>▁  　 \x00 tab\t\ttab"),
        (None, "null id"),
        (None, "null id"),
        (13, "a b c d e f g"),
        (13, "another text under the same id"),
        (15, " ".join(base)),
        (16, "z" * 450),
    ]
    return rows + [(100 + i, " ".join(words(50 + i, 30 + i))) for i in range(40)]


@pytest.fixture(scope="session")
def docs(spark, texts, tmp_path_factory):
    """The texts as a stored table of several files, with extra columns named as the operators' own."""
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    rows = [(i, t, "clash", 0, 1, 2) for i, t in texts]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def as_sets(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
