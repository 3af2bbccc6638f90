import os

import pyarrow as pa
import pyarrow.parquet as pq
from marquee.llm import blocks, common, decontaminate
from marquee.session import staged


def test_batches_for_python_are_bounded_in_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["n", "size"])

    wide = spark.range(0, 120, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 40000) AS text")
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    for step in (lambda: blocks.in_blocks(wide), lambda: decontaminate.contaminated(wide, bench)):
        spark.conf.unset(common.BATCH_CONF)
        step()
        got = wide.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r["n"] for r in got) == 120 and max(r["size"] for r in got) < 2 * common.BATCH_BYTES


def test_a_bound_of_the_session_stays(spark):
    spark.conf.set(common.BATCH_CONF, "1m")
    common.in_small_batches(spark.range(1))
    assert spark.conf.get(common.BATCH_CONF) == "1m"
    spark.conf.unset(common.BATCH_CONF)


def test_staged_row_groups_are_bounded_for_wide_rows(spark):
    def noise(batches):
        for b in batches:
            for _ in range(b.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array([os.urandom(1 << 20)], pa.binary())], names=["data"])

    out = staged(spark.range(0, 70, 1, 1).mapInArrow(noise, "data binary"), "wide")
    (path,) = {f.removeprefix("file:") for f in out.inputFiles()}
    found = pq.ParquetFile(path.replace("//", "/")).metadata
    assert found.num_rows == 70 and max(found.row_group(i).total_byte_size for i in range(found.num_row_groups)) < 40 << 20
    assert out.count() == 70
