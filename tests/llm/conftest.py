import random

import pytest
from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 3):
    """Rows with copies, near copies, shared passages, runs, nulls in any column, empty and long texts, repeated rows and ids."""
    r = random.Random(seed)
    words = {lang: [f"{p}{s}" for p in ps for s in ss] for lang, ps, ss in (("en", ("the", "wh", "th", "an"), ("ing", "er", "ly", "ore")), ("fr", ("le", "qu", "é", "eau"), ("ment", "eux", "ère", "oi")))}
    say = lambda lang, n: " ".join(r.choice(words[lang]) + r.choice(["", "", ".", ",", "\n", str(r.randrange(50))]) for _ in range(n))
    passage, rows = say("en", 70), []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        rows.append([i, say(lang, r.choice([3, 40, 120])), lang, r.choice(["a", "b", None, "hot", "hot"])])
    base = say("en", 150)
    for i in range(60, 80):
        t = base.split(" ")
        for _ in range(r.randrange(4)):
            t[r.randrange(len(t))] = "edit" + str(i)
        rows.append([i, " ".join(t), "en", "hot"])
    rows += [[80 + i, rows[i][1] + " " + passage + " " + rows[i + 1][1], "en", "b"] for i in range(6)]
    rows += [[90, "", "en", "a"], [91, None, "fr", "a"], [92, "   \n\t ", None, "a"], [93, "123 !? 456", "en", None], [94, "go " * 90, "en", "a"], [95, say("en", 6000), "en", "long"], [96, rows[5][1], "en", "hot"], [97, "éé", None, "a"]]
    rows += [list(rows[7]), list(rows[7]), [8, say("en", 50), "en", "a"], [None, base, None, None], [None, say("fr", 60), "fr", "b"]]
    r.shuffle(rows)
    return [(*x, None if x[1] is None else len(x[1])) for x in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf(spark, rows, tmp_path_factory):
    """A folder of tables with extra columns whose names clash with those of operators."""
    from pyspark.sql import functions as F

    top = tmp_path_factory.mktemp("sf")
    df = spark.createDataFrame(rows, SCHEMA)
    df.withColumns({c: F.lit("x") for c in ("size", "score", "key", "block", "rate", "copies", "id", "label", "_n", "_key", "bucket", "n_words", "length")}).write.parquet(f"{top}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (4, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    pages = [(i, f"http://x/{i}", f"<html>{i}</html>" * (i % 4)) for i in range(300)] + [(None, None, None), (5, "http://x/5", "<html>5</html>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{top}/pages.parquet")
    return str(top)
