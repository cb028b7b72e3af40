"""A small corpus with every awkward case."""

import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long, row string, node long, blk int, kept_text string, n_words int, label double"


def make_corpus(seed=3, n=70):
    """Rows with exact and near copies, shared lines and passages, junk, nulls, empty and long texts, repeated ids."""
    rng = random.Random(seed)
    syllables = "an er on in the re ing ed tion ou ha es st or ti he wh ble nd sh".split()
    common = "the of and to in a is that for it was on are with as".split()
    word = lambda: rng.choice(common) if rng.random() < 0.3 else "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    prose = lambda k: "\n".join(" ".join(word() for _ in range(min(25, k - i))) for i in range(0, k, 25))
    passage, boiler = " ".join(word() for _ in range(60)), "Read more at page {} of our site now"
    rows = []
    for i in range(n):
        text = prose(rng.randint(60, 200))
        if i % 4 == 0:
            text += "\n" + boiler.format(i * 7)
        if i % 9 == 0:
            text = text + " " + passage
        rows.append([i * 3 + 1, text])
    for i in range(0, 24, 2):
        rows.append([500 + i, rows[i][1]])
        w = rows[i + 1][1].split(" ")
        w[len(w) // 2] = "CHANGED"
        rows.append([501 + i, " ".join(w)])
    rows += [[900, None], [901, ""], [902, " \n\t "], [903, "one"], [904, "Two words"], [905, "two WORDS"], [906, prose(9000)],
             [907, "### $$$ %%% &&& ||| *** " * 40], [908, "again and " * 100], [909, "éàü ñandú ßtraße 漢字 " * 30], [910, "x" * 20000],
             [911, "A!! B!! C!! D!! E!! F!! G!! " * 20], [None, rows[0][1]], [None, None], [912, rows[5][1]], [912, prose(80)], [913, rows[3][1]], [913, rows[3][1]],
             [50, "Read more at page 5 of our site now"], [915, " ".join(word().upper() + rng.choice(["###", "$$$"]) for _ in range(150))], [914, "a\x00b\x85c\xa0d <|endoftext|> it's"]]
    rng.shuffle(rows)
    langs = ["en", "fr", None, "xx"]
    return [(d, t, langs[0] if i % 5 else langs[i // 5 % 4], f"s{i % 3}" if i % 7 else None, None if t is None else len(t), "r", i, i, "k", i, 0.5) for i, (d, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def corpus_rows():
    return make_corpus()


@pytest.fixture(scope="session")
def corpus(spark, corpus_rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark.createDataFrame(corpus_rows, DDL).repartition(5, "blk")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DDL)
