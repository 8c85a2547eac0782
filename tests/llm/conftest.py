import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from helpers import prose  # noqa: E402

#: Columns whose names the operators use themselves.
CLASHES = ("row", "rid", "id", "text_key", "sig", "kept", "size", "weight", "target", "fp", "runs", "items", "text_sha", "bucket", "judged")


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text, lang, source): nulls in every column, empty, blank, very long, tied and repeated rows."""
    rng = random.Random(9)
    base = prose(rng, 300)
    words = base.split()
    near = " ".join(words[:150] + ["changed"] + words[151:])
    long = prose(rng, 60_000)
    assert len(long) > 1 << 18
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, None, "en", "b"), (5, "", None, "b"),
        (None, "no id " + prose(rng, 40), "de", "c"), (None, None, None, None), (6, "   \n\t ", "fr", None),
        (7, long, "en", "c"), (8, long + " end", "en", "c"), (9, "!!! ???", "es", "a"), (10, "word", "es", "a"),
        (11, prose(rng, 80), "en", "a"), (11, prose(rng, 80), "en", "a"), (12, "twin " + base[:700], "en", "d"), (12, "twin " + base[:700], "en", "d"),
        (13, "Straße ünïcödé 日本語 текст " + prose(rng, 20), "de", ""), (14, "x" * 5000, "en", "d"), (15, "ab" * 2500, "en", "d"),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns that clash with names used inside."""
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    rows = [(*r, len(r[1] or ""), *CLASHES) for r in edge_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
