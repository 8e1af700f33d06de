import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken string, version string, cls string, size string"
WORDS = [a + b for a in ("ba", "do", "ke", "lu", "mi", "no", "pa", "ri", "so", "tu") for b in ("", "n", "r", "st", "ling")]


def sentence(draw, n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


def edited(draw, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[draw.randrange(len(words))] = draw.choice(WORDS) + "x"
    return " ".join(words)


def corpus():
    """Texts with exact and near copies, shared passages and odd shapes, as rows
    of (id, text); ids may be null or twice, and rows may be repeated."""
    draw = random.Random(5)
    passage, long = sentence(draw, 120), sentence(draw, 400)
    rows = [(i, sentence(draw, draw.randint(1, 160))) for i in range(40)]
    rows += [(100 + i, long) for i in range(6)]
    rows += [(200 + i, edited(draw, long, 1 + i)) for i in range(12)]
    rows += [(300 + i, sentence(draw, 20 + i) + " " + passage + "\n" + sentence(draw, 30)) for i in range(8)]
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "one"), (404, "a a a a " * 200), (405, "é 漢字 😀\r\n" * 120)]
    rows += [(406, "x" * 3000), (407, "no break " + "y" * 900 + passage[:500])]
    rows += [(None, long), (None, sentence(draw, 90)), (None, None), (500, passage), (500, long + " end"), (501, passage), (501, passage)]
    return rows


def as_table(spark, rows):
    sources = ("a", "b", "ä", None)
    full = [(i, t, "en", sources[k % 4], 0, "t", "v", "c", "s") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def documents(spark, rows):
    from stewardry.llm.staging import prepare

    return as_table(prepare(spark), rows)


@pytest.fixture(scope="module")
def empty(documents):
    return documents.limit(0)
