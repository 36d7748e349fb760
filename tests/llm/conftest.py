import random

import pytest

CLASH = "key long, start long, n long, words string, seed string, equal int, bucket int, fp string, taken int, ranges string, path string, source2 string"


def prose(rng, n):
    syllables = ["th", "an", "er", "on", "re", "St", "é", "ing", "ou", "ß"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) + rng.choice(["", "", ".", ",\n"]) for _ in range(n))


def hazard_rows():
    """Documents with every awkward case: (doc_id, text, source)."""
    rng = random.Random(7)
    base = [prose(rng, rng.randint(60, 160)) for _ in range(12)]
    passage = prose(rng, 80)
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20, None, "s0"), (21, "", "s1"), (22, " \t\n\x0b", None), (23, "one", None), (24, "two words", "Z")]
    rows += [(30 + i, prose(rng, 40) + " " + passage + " " + prose(rng, 30), "s2") for i in range(4)]
    rows += [(40 + i, base[0], "s0") for i in range(5)]  # exact copies
    near = base[1].split(" ")
    near[len(near) // 2] = "changed"
    rows += [(50, " ".join(near), "s1")]
    rows += [(60, "For " * 300, "s0"), (61, "x" * 5000, "s1"), (62, "ab" * 3000 + " z", "s1")]  # periodic texts
    rows += [(70, "\n".join(["same line here"] * 30 + [prose(rng, 50)]), "s2"), (71, "### $$ %% && " * 60, "s2")]
    rows += [(80, "<|endoftext|> is text \\### </turn>  double  space \n\n end  ", "s0")]
    rows += [(90, prose(rng, 30_000), "s1")]  # very long
    rows += [(0, base[0], "s0"), (0, base[0], "s0")]  # repeated rows
    rows += [(None, base[2] + " tail", None)]
    return rows


def frame(spark, rows):
    """Rows as documents, with columns whose names the operators use inside."""
    data = [(i, t, "en", s, len(t or ""), *([1] * 3), "w", "s", 1, 1, "f", 1, "r", "p", "z") for i, t, s in rows]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


@pytest.fixture(scope="session")
def rows():
    return hazard_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, []).limit(0)
