import zlib
from collections import Counter

import numpy as np
import pytest

from candlewright.llm import sharding as op


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation_and_inverse(n):
    out = op.permute(np.arange(n), n)
    assert sorted(out) == list(range(n))
    assert (op.permute(out, n, inverse=True) == np.arange(n)).all()


ROWS = [(i, f"text {i % 50}") for i in range(331)] + [(None, None), (None, None), (5, "text 5"), (5, "é" * 50_000), (6, "")]


def test_law_slots_and_content(docs_of):
    rows = op.shard_rows(docs_of(ROWS)).collect()
    assert len(rows) == len(ROWS)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    numbers = op.row_at(np.array([r["shard"] for r in rows]), np.array([r["slot"] for r in rows]), len(rows), 16)
    assert list(numbers) == [r["row_number"] for r in rows]


def test_reproducible_and_spread(docs_of):
    a = sorted(map(tuple, op.shard_rows(docs_of(ROWS, 2)).collect()), key=str)
    assert a == sorted(map(tuple, op.shard_rows(docs_of(ROWS, 7)).withColumnRenamed("x", "y").collect()), key=str)
    hot = op.shard_rows(docs_of([(i, "same") for i in range(160)])).collect()
    assert set(Counter(r["shard"] for r in hot).values()) == {10}


def test_empty_table_and_clashing_names(docs_of):
    assert op.shard_rows(docs_of([])).count() == 0
    docs = docs_of(ROWS[:5]).withColumn("size", op.F.lit(1)).withColumn("row_number", op.F.lit(1))
    assert op.shard_rows(docs).count() == 5
