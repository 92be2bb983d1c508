"""Frames for the tests of the training-data operators."""

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Rows of `documents` from texts, or from tuples that start like its columns."""

    def make(rows, partitions=3):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            full.append((*row, *["en", "src0", None][len(row) - 2 :]))
        frame = spark.createDataFrame(full, DOCUMENTS)
        return frame.repartition(partitions) if rows else frame

    return make
