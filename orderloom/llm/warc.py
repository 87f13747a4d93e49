"""WARC archives: write records, read them back, and assemble request, response and metadata into captures."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import attach_groups, staged, text_or_empty

RECORDS_PER_FILE = 900
REVISIT_FROM = 100  # bytes; equal payloads below this size are stored each time
RECORD_SCHEMA = ("record_id string, type string, concurrent_to string, refers_to string, uri string, "
                 "digest string, payload_bytes long, payload_sha256 string, fields map<string,string>")


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without the blank lines that end it. A header whose value is null is left out."""
    clean = [F.when(v.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(v, r"[\r\n]", " "), F.lit("\r\n")))
             .otherwise(F.lit("")) for name, v in headers]
    return F.concat(F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <"), record_id, F.lit(">\r\n"), *clean,
                    F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def record_urn(kind: str, capture: Column) -> Column:
    return F.concat(F.lit(f"urn:capture:{kind}:"), F.coalesce(capture.cast("string"), F.lit("null")))


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_sha256, refers_to``: of equal payloads of REVISIT_FROM bytes or more, the one
    with the smallest id is stored, and the others refer to it. Payloads are equal when their SHA-256 is."""
    rows = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         text_or_empty(payload_col).alias("payload"))
            .withColumn("payload_sha256", F.sha2("payload", 256)))
    groups = (rows.filter(F.octet_length("payload") >= REVISIT_FROM).groupBy("payload_sha256")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n_equal")).filter("n_equal > 1"))
    found = attach_groups(rows, staged(groups, "equal-payloads"), "payload_sha256", "n_equal", "page_id")
    other = F.col("first_id") != F.col("page_id")
    return found.withColumn("refers_to", F.when(other | F.col("page_id").isNull(), F.col("first_id"))).drop(
        "first_id", "n_equal")


def write_archive(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write rows of `with_revisits` as gzipped WARC files: for each page a request, a response or revisit, and a
    metadata record. The blank lines between records are the line separator of Spark's text writer."""
    capture = F.col("page_id")
    stays = F.col("refers_to").isNull()
    main_id = record_urn("response", capture)
    when, uri = ("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url"))
    beside = ("WARC-Concurrent-To", F.concat(F.lit("<"), main_id, F.lit(">")))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_sha256")))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    response = _record("response", main_id, [
        when, uri, digest, ("Content-Type", F.lit("application/http;msgtype=response"))], F.concat(http, "payload"))
    revisit = _record("revisit", main_id, [
        when, uri, digest, ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.concat(F.lit("<"), record_urn("response", F.col("refers_to")), F.lit(">"))),
        ("Content-Type", F.lit("application/http;msgtype=response"))], http)
    path = F.coalesce(F.regexp_extract("url", r"^[a-z]+://[^/\s]+(/\S*)", 1), F.lit(""))
    request = _record("request", record_urn("request", capture), [
        when, uri, beside, ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.when(path == "", F.lit("/")).otherwise(path), F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = _record("metadata", record_urn("metadata", capture), [
        when, uri, beside, ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("captureId: "), F.coalesce(capture.cast("string"), F.lit("null")), F.lit("\r\n")))
    records = F.array(request, F.when(stays, response).otherwise(revisit), metadata)
    (pages.select(F.explode(records).alias("value")).write.option("lineSep", "\r\n\r\n")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(folder))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record; lengths rule, so a block may hold anything."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(headers["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at byte {at} is cut short")
        yield headers, block
        at = end + 4 + size


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").splitlines()
    return {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k.strip()}


def read_archive(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per record of RECORD_SCHEMA, and ``payload`` (binary) if asked for. Length and SHA-256 are those of
    the payload as read: the block behind the HTTP header, if it has one."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else bytes(data)
                out = []
                for head, block in parse_records(data):
                    http = head.get("content-type", "").startswith("application/http")
                    payload = block.partition(b"\r\n\r\n")[2] if http else block
                    kind = head.get("warc-type")
                    row = [head.get("warc-record-id", "").strip("<>"), kind,
                           head["warc-concurrent-to"].strip("<>") if "warc-concurrent-to" in head else None,
                           head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
                           head.get("warc-target-uri"), head.get("warc-payload-digest"), len(payload),
                           hashlib.sha256(payload).hexdigest(), _fields(block) if kind == "metadata" else None]
                    out.append(row + [payload] if with_payload else row)
                if out:
                    yield pd.DataFrame(out, columns=names)

    schema = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    names = [part.split()[0] for part in schema.replace("map<string,string>", "map").split(", ")]
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInPandas(parse, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture_id``, ``response``, ``request`` and ``metadata``.

    ``response`` is the response or revisit record. A request or metadata record belongs to the response it is
    concurrent to, named on either side, or to that of a record it is concurrent to. Of several responses or
    requests the smallest record id counts; metadata records come as an array in order of their ids. Records that
    repeat under one id are one record. A request or metadata record without response makes a capture of its own.
    Only headers travel through the joins: keep payloads out of ``records`` and join them on by record id.
    """
    names = [c for c in records.columns if c not in ("record_id", "payload")]
    rows = staged(records.groupBy("record_id").agg(
        F.min(F.struct(*[c for c in names if c != "fields"])).alias("r"), F.any_value("fields").alias("fields"))
        .select("record_id", "r.*", "fields"), "records")
    named = rows.filter("concurrent_to is not null").select("record_id", "concurrent_to")
    links = named.union(named.select("concurrent_to", "record_id")).toDF("a", "b").distinct()
    main = rows.filter(F.col("type").isin("response", "revisit"))
    sides = rows.filter(F.col("type").isin("request", "metadata"))
    near = (sides.select("record_id").join(links, F.col("a") == F.col("record_id"))
            .join(main.select(F.col("record_id").alias("m")), F.col("b") == F.col("m"))
            .groupBy("record_id").agg(F.min("m").alias("owner")))
    # a metadata record may name the request and not the response
    far = (sides.select("record_id").join(near.select("record_id"), "record_id", "left_anti")
           .join(links, F.col("a") == F.col("record_id"))
           .join(near.select(F.col("record_id").alias("n"), "owner"), F.col("b") == F.col("n"))
           .groupBy(sides["record_id"]).agg(F.min("owner").alias("owner")))
    owned = (sides.join(near.union(far), "record_id", "left")
             .withColumn("capture_id", F.coalesce("owner", "concurrent_to", "record_id")))
    one = F.struct("record_id", "uri", "digest", "payload_bytes", "payload_sha256")
    beside = owned.groupBy("capture_id").agg(
        F.min(F.when(F.col("type") == "request", one)).alias("request"),
        F.sort_array(F.collect_list(F.when(F.col("type") == "metadata", F.struct(
            "record_id", "uri", F.to_json("fields").alias("fields"))))).alias("metadata"))
    response = F.struct("record_id", "type", "uri", "digest", "payload_bytes", "payload_sha256", "refers_to")
    return (main.select(F.col("record_id").alias("capture_id"), response.alias("response"))
            .join(beside, "capture_id", "full_outer").select("capture_id", "response", "request", "metadata"))


def full_payloads(captures: DataFrame) -> DataFrame:
    """Captures that have a response, with length and SHA-256 of the full payload: ``payload_bytes``,
    ``payload_digest``. A revisit has them from the response it refers to, however many refer to it."""
    main = captures.filter("response is not null").withColumn("_refers", F.col("response.refers_to"))
    stored = main.filter("_refers is null").select(
        F.col("capture_id").alias("_id"), F.col("response.payload_bytes").alias("_bytes"),
        F.col("response.payload_sha256").alias("_sha"))
    referred = main.filter("_refers is not null").groupBy("_refers").agg(F.count(F.lit(1)).alias("_n"))
    groups = staged(referred.join(stored, F.col("_refers") == F.col("_id")).select("_refers", "_n", "_bytes", "_sha"),
                    "referred")
    # rows that refer to nothing are dealt by their own id, not all under one null key
    keyed = main.withColumn("_refers", F.coalesce("_refers", F.concat(F.lit("-"), F.col("capture_id"))))
    return (attach_groups(keyed, groups, "_refers", "_n", "capture_id")
            .withColumn("payload_bytes", F.coalesce("_bytes", "response.payload_bytes"))
            .withColumn("payload_digest", F.coalesce("_sha", "response.payload_sha256"))
            .drop("_refers", "_n", "_bytes", "_sha"))


def archive_captures(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                     payload_col: str = "html") -> DataFrame:
    """Write ``pages`` to WARC files under ``folder``, read them back, and return one nested row per capture.

    A null payload is empty; a null url leaves its header out; line breaks in a url become spaces. A null id is
    written as "null". Rows that repeat under one id are one capture. An empty table gives no rows. Other columns
    are not read.
    """
    spark = pages.sparkSession
    write_archive(with_revisits(pages, id_col, url_col, payload_col), folder)
    return full_payloads(staged(assemble(read_archive(spark, folder)), "captures"))
