"""Long texts reach Python in small batches, unless the session says how large they are."""

import pyarrow as pa

from tablekit.llm import common
from tablekit.session import BATCH_BYTES


def _largest(frame):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    return max(r["n"] for r in frame.mapInArrow(sizes, "n bigint").collect())


def test_batches_are_bounded_by_bytes(spark):
    key, before = BATCH_BYTES[0], spark.conf.get(BATCH_BYTES[0], None)
    docs = spark.range(400, numPartitions=1).selectExpr("id AS doc_id", "repeat('word', 10000) AS text")
    try:
        spark.conf.unset(key)
        assert _largest(common.keyed(docs, "doc_id", "text").select("id", "text")) < 6_000_000
        spark.conf.set(key, "1m")
        assert _largest(common.keyed(docs, "doc_id", "text").select("id", "text")) < 2_000_000
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
