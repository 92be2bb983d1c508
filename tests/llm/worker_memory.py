"""What the Python worker of a fresh session holds after a stage of the pipeline, in MB: quality or near_dedup."""

import random
import re
import sys
from pathlib import Path

import pyarrow as pa

from candlewright.session import local_session


def held(batches):
    for _ in batches:
        told = Path("/proc/self/smaps_rollup").read_text()
        yield pa.RecordBatch.from_arrays([pa.array([int(re.search(r"\nAnonymous:\s+(\d+)", told)[1]) >> 10])], names=["mb"])


if __name__ == "__main__":
    import corpus_pipeline

    draw = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [" ".join("".join(draw.choices(letters, k=draw.randint(2, 9))) for _ in range(300)) for _ in range(4000)]
    spark = local_session(1, **{"spark.driver.memory": "1g"})
    docs = spark.createDataFrame([(i, text, None, None, len(text)) for i, text in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)[sys.argv[1]]
    stage(spark, docs.coalesce(1), "worker-memory").write.format("noop").mode("overwrite").save()
    rows = spark.range(1, numPartitions=1).mapInArrow(held, "mb long").collect()
    print("held", rows[0]["mb"])
    spark.stop()
