import pyarrow as pa
from pyspark.sql import functions as F

from weblattice.llm.common import BATCH_BYTES, BATCH_LIMIT, ship


def sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])


def test_a_batch_of_texts_is_bounded_in_bytes(spark):
    """Before, 10,000 texts went to a worker at once, however long."""
    spark.conf.unset(BATCH_LIMIT)
    ship(spark)
    docs = spark.range(0, 10_000, 1, 1).select("id", F.repeat(F.lit("onth and "), 300).alias("text"))
    got = docs.mapInArrow(sizes, "n bigint, size bigint").collect()
    assert sum(r["n"] for r in got) == 10_000
    assert max(r["size"] for r in got) < 1.5 * BATCH_BYTES


def test_a_bound_of_the_session_stays(spark):
    spark.conf.set(BATCH_LIMIT, "1000000")
    ship(spark)
    assert spark.conf.get(BATCH_LIMIT) == "1000000"
    spark.conf.unset(BATCH_LIMIT)
