"""A content-addressed WARC archive.

Payloads are stored once under their SHA-256; the exact headers of every record are
kept apart, with the address of the payload. Reading joins the two and gives the
original records back, byte for byte, after checking every payload against its address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duolect.llm.common import SALT_ROWS, attach, same
from duolect.session import materialize, workspace

# Equal payloads of fewer bytes are each a response of their own.
LEAST_REVISIT = 1000
# Fixed values of the WARC 1.1 and HTTP formats.
END = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _header(date: str) -> Column:
    """The record's bytes before its payload: WARC headers and, for a response, HTTP headers."""
    size = F.col("payload_bytes").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), size, F.lit(END + END))
    is_response = F.col("refers_to").isNull()
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    block = F.when(is_response, F.length(http) + F.col("payload_bytes")).otherwise(F.lit(0)).cast("string")
    named = lambda of: F.concat(F.lit(f"<{RECORD_ID}"), of.cast("string"), F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{END}"), _line("WARC-Type", F.when(is_response, "response").otherwise("revisit")),
        _line("WARC-Record-ID", F.coalesce(named(F.col("page_id")), F.lit(f"<{RECORD_ID}>"))),
        _line("WARC-Target-URI", url), _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Refers-To", named(F.col("refers_to"))), _line("WARC-Profile", F.when(~is_response, F.lit(REVISIT))),
        _line("Content-Type", F.when(is_response, F.lit("application/http; msgtype=response"))), _line("Content-Length", block),
        F.lit(END), F.when(is_response, http).otherwise(F.lit(""))).cast("binary")


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Store a record per row of ``pages`` (page_id, url, html): tables ``records`` and ``payloads``.

    A null html is an empty payload. Of equal payloads of at least ``LEAST_REVISIT``
    bytes the one with the largest page_id is a response and the others revisit it;
    rows that repeat that page_id are responses too, and so are rows without a page_id,
    which are never referred to. A null url gives no target line, and line ends in a url
    are escaped. Other columns are not read. Every payload is stored once, also short ones.
    """
    spark = pages.sparkSession
    rows = materialize(pages.select(
        "page_id", F.col("url").cast("string").alias("url"), F.octet_length(_payload()).cast("long").alias("payload_bytes"),
        F.sha2(_payload(), 256).alias("address"), F.sha1(_payload()).alias("sha1")), "warc-rows")
    groups = materialize(rows.groupBy("address").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("copies"))
                         .where("copies > 1"), "warc-groups")
    grouped = materialize(attach(rows, groups, "address", "copies", rows.count(), ["page_id"]), "warc-grouped")
    older = (F.col("page_id") < F.col("found.largest")) & (F.col("payload_bytes") >= LEAST_REVISIT)
    records = grouped.withColumn("refers_to", F.when(older, F.col("found.largest")))
    (records.select("page_id", _header(date).alias("header"), "address", F.coalesce("found.copies", F.lit(1).cast("long")).alias("copies"))
     .write.option("compression", "zstd").parquet(f"{path}/records"))
    _stored(spark, pages, grouped).write.option("compression", "zstd").parquet(f"{path}/payloads")


def _stored(spark: SparkSession, pages: DataFrame, grouped: DataFrame) -> DataFrame:
    """Address, payload and number of records, once for every address."""
    shared = grouped.where("found is not null")
    addressed = pages.select("page_id", F.sha2(_payload(), 256).alias("address"), _payload().alias("payload"))
    one = F.lit(1).cast("long").alias("copies")
    if shared.isEmpty():
        return addressed.select("address", "payload", one)
    ids = materialize(shared.select(F.col("page_id").alias("_page"), F.col("address").alias("_address"), F.col("found.copies").alias("_copies"),
                                    (same(F.col("page_id"), F.col("found.largest"))).alias("_first")), "warc-shared")
    where = same(F.col("page_id"), F.col("_page")) & (F.col("address") == F.col("_address"))
    single = addressed.join(ids, where, "left_anti").select("address", "payload", one)
    first = (addressed.join(ids.where("_first").distinct(), where).select("address", "payload", F.col("_copies").alias("copies"))
             .dropDuplicates(["address"]))
    return single.unionByName(first)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: header, payload, record (the original bytes).

    ``payload`` is the full payload also for revisits, whose record does not hold it.
    Reading fails if a stored payload does not have the digest it is stored under, or if
    a record's is missing. Records of an address are dealt out ``SALT_ROWS`` at a time.
    """
    salts = F.ceil(F.col("copies") / SALT_ROWS).cast("int")
    records = spark.read.parquet(f"{path}/records")
    records = records.withColumn("salt", F.pmod(F.xxhash64("page_id", "header"), salts).cast("int")).drop("copies")
    payloads = spark.read.parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest "), "address")))
    payloads = payloads.select("address", checked.alias("payload"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    joined = records.join(payloads, ["address", "salt"], "left")
    found = F.when(F.col("payload").isNull(), F.raise_error(F.concat(F.lit("no payload "), "address"))).otherwise(F.col("payload"))
    end = F.lit(END + END).cast("binary")
    body = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return joined.select("header", found.alias("payload")).select("header", "payload", F.concat("header", body, end).alias("record"))


def field(name: str) -> Column:
    """The value of a record's WARC header line; empty if it has none."""
    return F.regexp_extract(F.decode("header", "UTF-8"), f"\r\n{name}: ([^\r\n]*)\r\n", 1)


def parse(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of records read back.

    The digest is worked out from the payload's bytes and must be the header's; the
    length must be what the header says.
    """
    digest = F.sha1("payload")
    head = F.octet_length(F.substring_index(F.decode("header", "UTF-8"), END + END, 1))
    sized = F.octet_length("record") == head + 4 + field("Content-Length").cast("long") + 4
    right = (F.concat(F.lit("sha1:"), digest) == field("WARC-Payload-Digest")) & sized
    named = lambda name: F.nullif(F.regexp_extract(field(name), f"^<{RECORD_ID}(-?[0-9]*)>$", 1), F.lit("")).cast("long")
    return records.select(
        named("WARC-Record-ID").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(right, digest).otherwise(F.raise_error(F.concat(F.lit("record does not match its header: "), F.decode("header", "UTF-8")))).alias("payload_digest"),
        field("WARC-Type").alias("record_type"), named("WARC-Refers-To").alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder and read it back."""
    path = workspace(pages.sparkSession, "warc-archive")
    write_archive(pages, path)
    return parse(read_archive(pages.sparkSession, path))
