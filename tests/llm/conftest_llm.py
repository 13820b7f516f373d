import random

import pytest

WORDS = [f"{a}{b}{c}" for a in ("ba", "du", "Mel", "é", "tor") for b in ("ri", "no", "ßa") for c in ("n", "l,", "x.")]
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, hash int, words string, spans string"


def text(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "  ", "\n"]) for _ in range(n)).strip()


@pytest.fixture(scope="session")
def benchmark_texts():
    rng = random.Random(5)
    long = text(rng, 40)
    return [(1, long), (2, " ".join(long.split()[5:30])), (3, text(rng, 15)), (10, "Zebra, quilt"), (11, "lone-word"),
            (12, None), (None, "no item id here at all"), (13, ""), (3, text(rng, 20)), (14, long)]


@pytest.fixture(scope="session")
def document_rows(benchmark_texts):
    """Texts with copies, shared passages, benchmark passages, nulls, ties and repeated rows."""
    rng = random.Random(4)
    texts = [text(rng, n) for n in (0, 1, 5, 12, 13, 14, 30, 60, 200, 200, 40)]
    shared = text(rng, 30)
    texts += [None, "", "   \n", shared, text(rng, 20) + " " + shared, shared + "\t" + text(rng, 9), shared.upper()]
    texts += [texts[8], texts[8], texts[8].replace(" ", "\n"), " ".join(texts[9].split()[:-1]), "a " * 60, "a " * 45]
    texts += [text(rng, 12) + " " + benchmark_texts[0][1], "ZEBRA quilt " * 3 + text(rng, 8), "lone, word", text(rng, 3000), text(rng, 100) + " zebra QUILT"]
    texts += ["<|endoftext|> 'S don't ÀÉ 12²", "Ωmega Σίσυφος İ ǅ", "x" * 40_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(2**40 + i, text(rng, 25) + " " + shared) for i in range(3)]
    rows += [rows[8], rows[8], (5, text(rng, 30)), (None, shared), (None, None), (7, None)]
    rng.shuffle(rows)
    return [(i, t, "en", rng.choice(["s0", "s0", "s1", None]), len(t or ""), "r", 1, "w", "s") for i, t in rows]


@pytest.fixture(scope="session")
def documents(spark, document_rows):
    return spark.createDataFrame(document_rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def benchmark(spark, benchmark_texts):
    return spark.createDataFrame([(i, t, "x") for i, t in benchmark_texts], "item_id bigint, text string, gram string")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df, *columns):
    """Rows in an order of their own, nulls first."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
