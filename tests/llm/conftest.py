import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, h int"


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts():
    """Texts with the awkward cases: null, empty, blank, ties, copies, very long, other scripts."""
    long = " ".join(f"word{i % 977} is {i * 7 % 13}" for i in range(9000))
    para = "the quick brown fox jumps over the lazy dog while seven wizards box with jolly green giants near the old mill pond " * 2
    return [None, "", " \n\t ", "a", "Hello world", para + "one.", para + "one.", para.replace("seven", "eight") + "one.", long,
            "x" * 3000, "naïve café — 你好世界 🎉 it's 12,345", "line one here\nline two here\nline one here\n\nLINE ONE HERE!"]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", "s1" if i % 3 else None, 0, "clash", 1) for i, t in enumerate(texts)]
    rows += [rows[6], (None, "no id at all here", "en", "s2", 0, "clash", 1), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
