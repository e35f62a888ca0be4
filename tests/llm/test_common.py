"""What the operators share."""

import pyarrow as pa
from pyspark.sql import functions as F

from tallywick.llm import common


def test_batches_are_bounded_in_bytes(spark):
    """Long texts come few at a time, and one beyond the bound by itself."""
    common.ready(spark)
    texts = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), F.when(F.col("id") == 30, 20 << 20).otherwise(1 << 20)).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    got = texts.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 60 and len(got) >= 7
    assert all(r["size"] <= 2 * common.BATCH_BYTES for r in got if r["size"] < 20 << 20)
