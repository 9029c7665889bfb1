"""A table of odd rows, and the smallest tables."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"
# Extra columns bear names that the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, uid string, row string, size string,"
    " rest string, open string, slot string, block string, start string, kept string, lines string, first string,"
    " length string, rank string, level string, root string, fp string, `group` string, key string, lane string,"
    " _ string, shard_ string, spare string, tree string, at string, place string, digest string, score string,"
    " bound string, item string, wanted string, ask string, held_out string, predicted string"
)


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), *["x"] * 33)


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs, empty, blank, very long, tied and repeated rows."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "Zeta.", "42", "x@y.org"]
    long_text = " ".join(rng.choice(words) for _ in range(40_000))
    rows = [
        row(1, None), row(2, ""), row(3, " \t\n"), row(None, None), row(None, "some words here"),
        row(None, "some words here"), row(4, "some words here"), row(4, "some words here"),
        row(5, "some  words here"), row(6, "some words here "), row(7, long_text, None), row(8, long_text + " end"),
        row(9, long_text, None), row(10, "a\nb\nc\na\nb\nc", None), row(11, "a\nb\nc"), row(None, "a\nb\nc\nd"),
        row(12, "Ünïcode 🙂 text"),
        *[row(100 + i, f"row {i % 5} of some text", f"s{i % 3}") for i in range(40)],
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
