"""WARC archives: writing captures with revisit records, reading them back, assembling transactions.

Archives are written and read by Spark's own text source, so any file system Spark knows will do and
a lost executor's files are never half kept. A record ends with two line ends, which is what the
writer puts after each row; in a gzip file, which is never split, the reader sees the pieces between
such line ends in order and joins them again by each record's Content-Length.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.llm.common import join_to_groups, stored, workspace

RECORD_END = "\r\n\r\n"
#: Payloads of fewer bytes are never stored as revisits.
REVISIT_BYTES = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = (
    "struct<record_id: string, record_type: string, target_uri: string, date: string, refers_to: string, "
    "payload_digest: string, payload_bytes: long, http_status: int, payload: binary>"
)


def record_id(kind: str, key: str) -> str:
    """A record's URI: a name-based UUID of the capture's key, so that a repeated task repeats it."""
    digest = hashlib.sha256(f"{kind}:{key}".encode()).hexdigest()
    return f"<urn:uuid:{digest[:8]}-{digest[8:12]}-8{digest[13:16]}-a{digest[17:20]}-{digest[20:32]}>"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", b"WARC-Type: " + kind.encode()]
    lines += [f"{k}: {v}".encode() for k, v in headers if v is not None]
    return b"\r\n".join([*lines, b"Content-Length: " + str(len(block)).encode(), b"", block])


def _one_line(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def plan_revisits(pages: DataFrame, id_col: str, payload_col: str, least: int, folder: str) -> DataFrame:
    """(_id, _digest, _first) of each row that is a revisit: whose payload an earlier row has."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("_id"), F.octet_length(payload).cast("long").alias("_bytes"), F.unhex(F.sha2(payload, 256)).alias("_digest"))
    rows = stored(rows, f"{folder}/digests")
    groups = stored(
        rows.where(F.col("_bytes") >= least).groupBy("_digest").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size")).where("_size > 1"),
        f"{folder}/groups",
    )
    return join_to_groups(rows.where(F.col("_bytes") >= least), groups, "_digest", "_size", rows.count()).where("_first <> _id").select("_id", "_digest", "_first").distinct()


def write_captures(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write request, response or revisit, and metadata record of each row to gzip WARC files.

    The payload is ``payload_col`` in UTF-8, null as empty. Of rows with equal payloads of at least
    ``least`` bytes the one with the least id is the response and others are revisits of it; rows
    with a null id are responses, whose record ids come from their url and payload. Rows that repeat an
    id repeat its capture under one record id; null urls are empty; other columns are left out. An empty table gives a folder without records.
    """
    folder = workspace(pages.sparkSession, "warc-plan")
    revisits = plan_revisits(pages, id_col, payload_col, least, folder)
    slim = pages.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("_url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("_payload"),
    ).withColumn("_digest", F.unhex(F.sha2("_payload", 256)))
    # a row without id revisits nothing: no join, in which all such rows would meet in one task
    rows = slim.where("_id is not null").join(revisits, ["_id", "_digest"], "left").drop("_digest")
    rows = rows.unionByName(slim.where("_id is null").drop("_digest").withColumn("_first", F.lit(None).cast(rows.schema["_first"].dataType)))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                key = "" if row["_id"] is None else str(row["_id"])
                url, payload = _one_line(row["_url"]), row["_payload"]
                # a row without id is named by what it holds
                name = key if row["_id"] is not None else f"null:{hashlib.sha256(url.encode()).hexdigest()}:{hashlib.sha256(payload).hexdigest()}"
                main = record_id("capture", name)
                shared = [("WARC-Target-URI", url), ("WARC-Date", date)]
                request = _record("request", [("WARC-Record-ID", record_id("request", name)), *shared, ("WARC-Concurrent-To", main), ("Content-Type", "application/http;msgtype=request")], f"GET {url} HTTP/1.1\r\n\r\n".encode())
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                digest = ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest())
                http = ("Content-Type", "application/http;msgtype=response")
                if row["_first"] is None:
                    capture = _record("response", [("WARC-Record-ID", main), *shared, digest, http], head + payload)
                else:
                    refers = record_id("capture", str(row["_first"]))
                    capture = _record("revisit", [("WARC-Record-ID", main), *shared, digest, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", refers), http], head)
                note = _record("metadata", [("WARC-Record-ID", record_id("metadata", name)), *shared, ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")], f"capture-key: {key}\r\n".encode())
                yield pa.record_batch([pa.array([request, capture, note], pa.binary())], names=["value"])

    records = rows.mapInArrow(run, "value binary")
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def _parse(pieces, with_payload: bool):
    """Records of (file, piece) rows in order. A record is its head's piece and the pieces that its
    Content-Length takes; a torn record at a file's end is given as far as it goes, marked truncated."""
    head, block, need, have, file = None, [], 0, 0, None

    def close(truncated):
        body = (RECORD_END.encode()).join(block)
        h = _headers(head)
        kind = h.get("warc-type")
        status, payload, length = None, body, len(body)
        if h.get("content-type", "").startswith("application/http"):
            top, gap, payload = body.partition(b"\r\n\r\n")
            first, _, rest = top.partition(b"\r\n")
            status = int(first.split()[1]) if first.startswith(b"HTTP/") and len(first.split()) > 1 and first.split()[1].isdigit() else None
            length = len(payload)
            if kind == "revisit":
                said = _headers(b"\r\n" + rest).get("content-length", "")
                length = int(said) if said.isdigit() else None
        digest = h.get("warc-payload-digest", "").rpartition(":")[2] if kind == "revisit" else hashlib.sha256(payload).hexdigest()
        return {
            "record_id": h.get("warc-record-id"), "record_type": kind, "concurrent_to": h.get("warc-concurrent-to"),
            "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date"), "refers_to": h.get("warc-refers-to"),
            "payload_digest": digest, "payload_bytes": length, "http_status": status, "truncated": truncated,
            "payload": payload if with_payload or kind in ("metadata", "request") else None,
        }

    for name, piece in pieces:
        if name != file:
            if head is not None:
                yield close(True)
            head, block, need, have, file = None, [], 0, 0, name
        while True:
            if head is None:
                start = piece.lstrip(b"\r\n")
                if start.startswith(b"WARC/"):
                    size = _headers(start).get("content-length", "0")
                    head, block, need, have = start, [], int(size) if size.isdigit() else 0, -len(RECORD_END)
                    if need == 0:  # an empty block: its end follows the head's at once
                        block = [b""]
                        yield close(False)
                        head = None
                break
            block.append(piece)
            have += len(piece) + len(RECORD_END)  # the block so far, its pieces joined once it is whole
            if have < need:
                break
            # a block that ends in a line end is cut early, and the next head then comes with it
            whole = RECORD_END.encode().join(block)
            block, piece = [whole[:need]], whole[need:]
            yield close(False)
            head = None
            if not piece.strip(b"\r\n"):
                break
    if head is not None:
        yield close(True)


RECORDS = pa.schema(
    [(n, pa.string()) for n in ("record_id", "record_type", "concurrent_to", "target_uri", "date", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("http_status", pa.int32()), ("truncated", pa.bool_()), ("payload", pa.binary())]
)
RECORDS_DDL = (
    "record_id string, record_type string, concurrent_to string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_bytes long, http_status int, truncated boolean, payload binary"
)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of gzip WARC files; bare SHA-256 (or stated) payload digests and full payload lengths.

    ``with_payload`` false leaves out the payloads of responses, whose digests are still computed. Each
    record is a row, repeated ones too; heads that lack a field have a null there; an empty archive gives no rows.
    """
    lines = spark.read.option("lineSep", RECORD_END).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches):
        def pieces():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

        held, size = [], 0
        for record in _parse(pieces(), with_payload):
            held.append(record)
            size += len(record["payload"] or b"") + 500
            if size > 4_000_000:
                yield pa.RecordBatch.from_pylist(held, schema=RECORDS)
                held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema=RECORDS)

    return lines.mapInArrow(run, RECORDS_DDL)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture, request, metadata), joined through concurrent-to ids.

    A capture is a response or revisit record; a request or metadata record belongs to the capture
    that it, or that names it, as concurrent. A capture with neither has nulls there; of several of a
    kind the least record id is taken; repeated capture records stay repeated. Records that belong
    to no capture are left out.
    """
    fields = [c.partition(":")[0].strip() for c in CAPTURE[7:-1].split(",")]
    capture = F.struct(*fields)
    is_capture = F.col("record_type").isin("response", "revisit")
    main = records.where(is_capture).select(F.col("record_id").alias("_id"), F.col("concurrent_to").alias("_to"), capture.alias("capture"))
    small = F.struct(F.col("record_id"), F.col("target_uri"), F.col("payload"))

    def side(kind):
        own = records.where(F.col("record_type") == kind)
        direct = own.where("concurrent_to is not null").groupBy(F.col("concurrent_to").alias("_id")).agg(F.min(small).alias(kind))
        named = own.groupBy(F.col("record_id").alias("_to")).agg(F.min(small).alias(f"_named_{kind}"))
        return direct, named

    sides = {kind: side(kind) for kind in ("request", "metadata")}
    out = main.where("_id is not null")
    for kind, (direct, _) in sides.items():
        out = out.join(direct, "_id", "left")
    none = [F.lit(None).cast(direct.schema[kind].dataType).alias(kind) for kind, (direct, _) in sides.items()]
    out = out.unionByName(main.where("_id is null").select("*", *none))
    # captures that name no concurrent record, as a rule all, take no part in the joins on that name
    naming = out.where("_to is not null")
    for kind, (_, named) in sides.items():
        naming = naming.join(named, "_to", "left").withColumn(kind, F.coalesce(kind, f"_named_{kind}")).drop(f"_named_{kind}")
    return out.where("_to is null").unionByName(naming).select("capture", "request", "metadata")


def capture_key(metadata: str = "metadata"):
    """The capture-key field of an assembled capture's metadata record."""
    return F.regexp_extract(F.col(f"{metadata}.payload").cast("string"), r"(?m)^capture-key: (.*?)\r?$", 1)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` as an archive, read it back, assemble it; one row per page.

    (id_col, payload_bytes, payload_digest, record_type, refers_to): refers_to is the id of the page
    whose response a revisit refers to. Null payloads are empty; null ids stay null (as do ids of no letters),
    and their rows are responses; rows that repeat give a row each; other columns, whatever their names, are
    ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = workspace(spark, "warc")
    kind = pages.schema[id_col].dataType
    write_captures(pages, f"{folder}/archive", id_col, url_col, payload_col, least)
    records = stored(read_warc(spark, f"{folder}/archive", with_payload=False), f"{folder}/records")
    captures = assemble(records).select(F.nullif(capture_key(), F.lit("")).cast(kind).alias("id"), "capture.*")
    captures = stored(captures, f"{folder}/captures")
    # only revisits refer; a response to which many do is a hot key, whose one row goes to theirs
    refer = captures.where("refers_to is not null")
    first = captures.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("id").alias("first")).distinct()
    asked = refer.groupBy("refers_to").agg(F.count(F.lit(1)).alias("size")).join(first, "refers_to", "left")
    told = join_to_groups(refer, stored(asked, f"{folder}/asked"), "refers_to", "size", refer.count())
    out = told.drop("size").unionByName(captures.where("refers_to is null").withColumn("first", F.lit(None).cast(kind)))
    return out.select(F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("first").alias("refers_to"))
