"""Content-addressed web archive.

Payload bytes are stored once under their SHA-256; the exact record headers stand apart; the original records come back by a join
of the two. A payload of fewer than ``min_bytes`` bytes is kept beside its header, since a link would be as long.

Of records with equal payloads the one with the smallest ``page_id`` is the response and the others revisit it. A record refers to
another by value: repeated rows with the smallest id are all responses; a NULL ``page_id`` sorts last. A NULL ``html`` is an empty
payload. An empty table gives an empty archive. Columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import partitions
from marquee.session import scratch_dir

CRLF = "\r\n"


def _header() -> F.Column:
    """WARC/1.1 header lines of one record. The date is fixed: it would otherwise differ between reruns."""
    revisit = F.col("record_type") == "revisit"

    def line(name: str, value) -> F.Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    text = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">")))).otherwise(""),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))),
        F.lit(CRLF),
    )
    return F.encode(text, "UTF-8")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 100) -> None:
    """Write the archive of ``pages`` (page_id, url, html) to ``path``: ``records`` and ``payloads``.

    Only digests are shuffled to find equal payloads. Payload bytes are shuffled once, to the bucket of their digest; each task
    drops the copies it has seen before it sends any, so the commonest payload crosses the network once for each task.
    """
    n = partitions(pages)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("n_bytes") >= min_bytes)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("digest", "first_id")
    small = F.col("n_bytes") < min_bytes
    typed = rows.select("page_id", "url", "digest", "n_bytes", F.when(small, F.col("payload")).alias("inline")).join(firsts, "digest", "left")
    revisit = ~small & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    typed = typed.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    records = typed.select("page_id", "record_type", "digest", _header().alias("header"), "inline")
    records.write.option("compression", "zstd").parquet(f"{path}/records")
    # One table of payloads, dealt and sorted by digest, so that reading it back for a join needs no further exchange.
    once = large.select("digest", "payload").dropDuplicates(["digest"])
    once.write.bucketBy(n, "digest").sortBy("digest").option("compression", "zstd").option("path", f"{path}/payloads").saveAsTable(_table(path))


def _table(path: str) -> str:
    return "payloads_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: page_id, digest, header, record (bytes). A revisit has no block of its own."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.table(_table(path))
    stored = (F.col("record_type") == "response") & F.col("inline").isNull()
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    joined = records.where(stored).join(payloads, "digest", "left")
    whole = joined.select("page_id", "digest", "header", F.concat("header", "payload", end).alias("record"))
    rest = records.where(~stored)
    return whole.unionByName(rest.select("page_id", "digest", "header", F.concat("header", F.coalesce("inline", F.lit(b"")), end).alias("record")))


def described(records: DataFrame) -> DataFrame:
    """What the bytes of the records say: type, target, length and digest of the payload, both computed anew.

    A record whose payload does not have the digest in its header stops the job.
    """

    def field(name: str) -> F.Column:
        return F.regexp_extract(F.decode("header", "UTF-8"), rf"(?m)^{name}: ([^\r\n]*)", 1)

    block = F.expr("substring(record, octet_length(header) + 1, octet_length(record) - octet_length(header) - 4)")
    seen = records.select(
        "page_id",
        "digest",
        field("WARC-Type").alias("record_type"),
        F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).try_cast("long").alias("refers_to"),
        F.octet_length(block).cast("long").alias("n_bytes"),
        F.sha2(block, 256).alias("seen"),
    )
    response = seen.where("record_type = 'response'")
    bad = F.raise_error(F.concat(F.lit("payload does not have its digest: "), F.col("digest")))
    response = response.withColumn("digest", F.when(F.col("seen") == F.col("digest"), F.col("digest")).otherwise(bad))
    # A response that is revisited; one row for each digest, its length as read.
    target = response.where("page_id is not null").groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"))
    revisit = seen.where("record_type = 'revisit'").drop("n_bytes", "seen").join(target, "digest", "left")
    columns = ["page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"]
    return response.select(columns).unionByName(revisit.select(columns))


def archive_round_trip(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Write an archive to the scratch folder and describe the records that come back."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_archive(pages, path, min_bytes)
    return described(read_archive(spark, path))
