import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parents[1]))

GOLDEN_FILES = {
    "1.txt": "The Wizard of Oz\nWIZARD, of: oz!",
    "10.txt": "a wizard here; the oz",
    "2.txt": "  --  ",
    "notes": "the nontxt",
    "notes2": "the other",
}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    for name, text in GOLDEN_FILES.items():
        (folder / name).write_text(text)
    return str(folder)


@pytest.fixture(scope="session")
def docs(spark, corpus):
    from inkdex import read_whole

    return read_whole(spark, corpus)


@pytest.fixture(scope="session")
def built(spark, docs, tmp_path_factory):
    """Folder of the stored golden index; N is the number of .txt files."""
    from inkdex import build_index

    out = str(tmp_path_factory.mktemp("index"))
    build_index(docs, out, n_docs=3)
    return out


@pytest.fixture(scope="session")
def index(spark, built):
    from inkdex import load_index

    return load_index(spark, built)


def rows(df, *columns):
    """Sorted rows as tuples, doubles rounded to six decimals."""
    picked = df.select(*columns) if columns else df

    def plain(value):
        return round(value, 6) if isinstance(value, float) else value

    return sorted(tuple(plain(v) for v in row) for row in picked.collect())


def ordered(df):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in df.collect()]
