"""Content-addressed web archive.

``write_archive`` stores each distinct payload once, deflated, under its
SHA-256 (``payloads/``), and the exact header bytes of every record apart from
it (``headers/``). ``read_archive`` joins the two and rebuilds each WARC/1.0
record: header, payload, two CRLF. The key is verified twice: when stored, all
records that share it must agree in length and SHA-1; when read, length, SHA-1
and SHA-256 of the inflated bytes must equal those named by the key and by the
header, else the read fails.

Of records with equal payloads of at least ``min_bytes`` bytes, that with the
largest id is the response and the others are revisits which refer to it
(identical-payload-digest profile); smaller payloads are all responses. A
revisit record carries no block in its WARC form; its full payload is still
rebuilt beside it.

Defined cases: a null payload is empty; a null or absent url gives a record
without target URI; a null id sorts below every other; rows repeated with the
same id, url and payload are one response and revisits to it (numbered by
``copy``); a payload shared by a third of all records is stored once and only
its digest is shuffled per record, so no task gathers the group.
"""

from __future__ import annotations

import hashlib
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clientlens.llm.shared import small_batches

_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_digest: Column, digits: int = 40) -> Column:
    """Upper-case base32 of a hex digest whose length is a multiple of 5
    digits (20 bits: 4 base32 letters)."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, i, 5), 16, 32), 4, "0") for i in range(1, digits, 5)]
    return F.translate(F.upper(F.concat(*parts)), _HEX, _BASE32)


def _deflate(level: int):
    def run(batches):
        for b in batches:
            raw = b.column("payload").to_pylist()
            z = pa.array([zlib.compress(x or b"", level) for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("sha256", "sha1", "n_bytes")), z],
                                             names=["sha256", "sha1", "n_bytes", "stored"])
    return run


def write_archive(pages: DataFrame, path: str, record_id: str = "page_id", url: str = "url", payload: str = "html",
                  min_bytes: int = 0, level: int = 6, date: str | None = None) -> None:
    """Write ``<path>/payloads`` and ``<path>/headers``. ``payload`` is a
    string (stored as UTF-8) or binary column. ``date`` is the WARC-Date of all
    records, as ``yyyy-MM-ddTHH:mm:ssZ``; by default the time of this call.
    Characters that can't stand in a header line are percent-encoded in the URL."""
    small_batches(pages.sparkSession)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    recs = pages.select(F.col(record_id).alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload")) \
        .withColumn("sha256", F.unhex(F.sha2("payload", 256))).withColumn("sha1", F.sha1("payload")) \
        .withColumn("n_bytes", F.length("payload").cast("long"))

    # payloads: one row per digest; equal digests must agree in length and SHA-1
    stored = recs.select("sha256", "sha1", "n_bytes", "payload") \
        .mapInArrow(_deflate(level), "sha256 binary, sha1 string, n_bytes long, stored binary")
    clash = F.raise_error(F.lit("two payloads share a SHA-256 but differ"))
    same = (F.col("n_lo") == F.col("n_bytes")) & (F.col("s_lo") == F.col("sha1"))
    stored.groupBy("sha256").agg(F.max("n_bytes").alias("n_bytes"), F.min("n_bytes").alias("n_lo"),
                                 F.max("sha1").alias("sha1"), F.min("sha1").alias("s_lo"),
                                 F.any_value("stored").alias("stored")) \
        .select("sha256", F.when(same, F.col("n_bytes")).otherwise(clash.cast("long")).alias("n_bytes"),
                "sha1", "stored") \
        .write.parquet(f"{path}/payloads")

    # headers: equal rows are counted, numbered and expanded; the digest's largest (id, url) owns the response
    rows = recs.groupBy("id", "url", "sha256", "sha1", "n_bytes").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("id", "url", "sha256", "sha1", "n_bytes", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    rank = F.struct(F.col("id").isNotNull().alias("known"), F.col("id").alias("id"), F.col("url").alias("url"))
    owner = recs.groupBy("sha256").agg(F.max(rank).alias("o")) \
        .select(F.col("sha256").alias("o_sha256"), F.col("o.id").alias("o_id"), F.col("o.url").alias("o_url"))
    j = rows.join(owner, F.col("sha256") == F.col("o_sha256"))
    own = F.col("id").eqNullSafe(F.col("o_id")) & F.col("url").eqNullSafe(F.col("o_url")) & (F.col("copy") == 1)
    response = own | (F.col("n_bytes") < min_bytes)
    j = j.withColumn("record_type", F.when(response, "response").otherwise("revisit")) \
        .withColumn("digest", base32(F.col("sha1")))

    def record_urn(i: Column, u: Column, copy: Column) -> Column:
        """A stable urn:uuid of id, url, payload digest and copy number."""
        m = F.md5(F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("")), F.coalesce(u, F.lit("")),
                              F.hex("sha256"), copy.cast("string")).cast("binary"))
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(m, a, n) for a, n in
                                                              ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    revisit = F.col("record_type") == "revisit"
    head = F.concat_ws(
        "", F.lit("WARC/1.0\r\n"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_urn(F.col("id"), F.col("url"), F.col("copy"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
                                 line("WARC-Refers-To", record_urn(F.col("o_id"), F.col("o_url"), F.lit(1))))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")), F.lit("\r\n"))
    j.select("id", "copy", "sha256", "record_type", F.when(revisit, F.col("o_id")).alias("refers_to"),
             head.cast("binary").alias("header")) \
        .write.parquet(f"{path}/headers")


def _rebuild(batches):
    """Inflate, verify and put records together; every batch is independent."""
    for b in batches:
        out, size, sha = [], [], []
        for z, key, head, kind in zip(*(b.column(c).to_pylist() for c in ("stored", "sha256", "header", "record_type"))):
            raw = zlib.decompress(z)
            digest = hashlib.sha1(raw).digest()
            if hashlib.sha256(raw).digest() != key:
                raise ValueError("a stored payload does not have the SHA-256 it is stored under")
            out.append(head + (raw if kind == "response" else b"") + b"\r\n\r\n")
            size.append(len(raw))
            sha.append(digest.hex())
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("id", "copy", "record_type", "refers_to", "header", "n_bytes")),
             pa.array(out, pa.binary()), pa.array(size, pa.int64()), pa.array(sha, pa.string())],
            names=["id", "copy", "record_type", "refers_to", "header", "n_bytes", "record", "payload_bytes", "sha1"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Rebuilt records: id, copy, record_type, refers_to, record (the WARC
    record's bytes), payload_bytes, payload_digest (both of the full payload,
    from the bytes read). A wrong key, length or header digest fails the job."""
    small_batches(spark)
    heads, pay = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    j = heads.join(pay.select(F.col("sha256").alias("p_sha256"), "n_bytes", "stored"), F.col("sha256") == F.col("p_sha256"), "left")
    id_type = heads.schema["id"].dataType.simpleString()
    built = j.select("id", "copy", "sha256", "record_type", "refers_to", "header", "n_bytes",
                     F.coalesce("stored", F.raise_error(F.lit("a header names a payload that is not stored")).cast("binary"))
                     .alias("stored")) \
        .mapInArrow(_rebuild, f"id {id_type}, copy long, record_type string, refers_to {id_type}, header binary, "
                              "n_bytes long, record binary, payload_bytes long, sha1 string")
    named = F.regexp_extract(F.col("header").cast("string"), r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]{32})\r\n", 1)
    digest = base32(F.col("sha1"))
    ok = (digest == named) & (F.col("n_bytes") == F.col("payload_bytes"))
    return built.select("id", "copy", "record_type", "refers_to", "record", "payload_bytes",
                        F.when(ok, digest).otherwise(F.raise_error(F.lit("payload and header disagree")).cast("string"))
                        .alias("payload_digest"))
