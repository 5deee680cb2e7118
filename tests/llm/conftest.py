import pytest

DOCS = "doc_id long, text string, lang string, k long, n int, low int, token string, component_id long, windows int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names clash with those the operators use inside."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, "en", 1, 2, 3, "x", 4, 5) for i, t in zip(ids, texts, strict=True)], DOCS)

    return make


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, shared passages, empty, null, short, long, other scripts, periodic words."""
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))
    base = [[word() for _ in range(rng.choice([3, 5, 20, 60, 120, 400]))] for _ in range(25)]
    passage, out = [word() for _ in range(70)], []
    for ws in base:
        out.append(" ".join(ws))
        for _ in range(rng.randint(0, 4)):
            near = list(ws)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = word()
            out.append(rng.choice([" ", "\n", "  \t"]).join(near))
        if rng.random() < 0.5:
            a = rng.randrange(0, 20)
            out.append(" ".join(ws[:10] + passage[a:] + ws[10:]))
    out += ["", None, " \n\t ", "one", "One", "one two three four", "ein  Ärger▁ 日本\x00語 ", "a " * 150, "a " * 90, "b c " * 100, passage and " ".join(passage * 3)]
    out += [out[0], out[0], out[0].upper()]
    return out
