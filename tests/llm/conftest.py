import random

import pytest

SCHEMA = ("doc_id long, text string, source string, n_chars long, slice int, bucket string, "
          "rest string, tokens string, epoch string, score string, y string, class string")
EXTRA = (7, "b", "r", "t", "e", "s", "y", "c")


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}é"[:rng.randrange(2, 6)] + str(rng.randrange(60))
            for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text, source): shared passages, copies, near copies and odd rows."""
    rng = random.Random(4)
    passage = words(rng, 70)
    lines = [" ".join(words(rng, 6)) for _ in range(4)]
    base = words(rng, 120)
    out = []
    for i in range(60):
        w = words(rng, rng.randrange(1, 160))
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(10):]
        if i % 5 == 0:
            w = list(base)
            for _ in range(i % 4 * 3):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(1000))
        text = " ".join(w)
        if i % 4 == 0:
            text = "\n".join([text, *lines, "tail " + str(i % 8)])
        out.append((i, text, f"s{min(i % 7, 3)}"))
    out += [(70, out[6][1], "s0"), (71, out[6][1], None), (72, None, "s1"), (73, "", "s1"),
            (74, " \t\n ", "s2"), (75, "one", "s2"), (76, "one", "s0"), (77, "ONE two\nthree", "s3"),
            (78, "one two three", "s3"), (None, out[3][1], "s0"), (None, None, None),
            (79, out[9][1], "s1"), (79, out[9][1], "s1"), (80, " ".join(words(rng, 30000)), "s0"),
            (81, "same " * 300, "s2"), (82, "a\x0bb\x0cc\rd e f", "s2"),
            (83, "\n\n\n\n\n\n", "s2"), (84, "x\n\n\n\n\n\n", "s2")]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(
        [(i, t, s, None if t is None else len(t), *EXTRA) for i, t, s in texts], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
