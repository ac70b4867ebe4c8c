"""WARC derivatives: response records to linked metadata and plain-text conversion records.

A response is a row with its WARC headers and its block (the HTTP message).  From each
come two records: ``metadata`` (JSON: the source's WARC headers, the HTTP status and
headers, payload length and digest, title and links) and ``conversion`` (all visible text).
Both name the response in WARC-Refers-To and each other in WARC-Concurrent-To, and keep
its target URI and date.  Record ids are name-based, so a rerun gives the same records.

Rows are mapped one by one; nothing is shuffled and no file is read whole.  ``read_records``
splits files between records and ``write_records`` writes them as text files of records.

Defined results: records of other types are left out; a null block is empty; a block
without an empty line is all headers; a missing header is left out of the derivative, a
missing record id is derived from the block; equal responses give equal derivatives;
other columns are dropped, ``keep`` names those to carry along.
"""

import base64
import hashlib
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanack.llm.base import register, table
from almanack.llm.html_extract import lines_of

SPACE = uuid.NAMESPACE_URL
FETCHED = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
VERSION = "WARC/1.0\r\n"
LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)", re.I)
CHARSET = re.compile(r"charset\s*=\s*[\"']?([^\"'\s;]+)", re.I)
TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)


def digest(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts):
    return f"<urn:uuid:{uuid.uuid5(SPACE, '|'.join(parts))}>"


def header_lines(text):
    """(first line, {name: value}) of a header block; later lines of a name are appended."""
    lines = text.split("\r\n")
    out, last = {}, None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip()
            out[last] = f"{out[last]}, {value.strip()}" if last in out else value.strip()
    return lines[0], out


def split_http(block):
    """(status line, headers, payload bytes)."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, headers = header_lines(head.decode("utf-8", "replace"))
    return status, headers, payload


def decoded(http, payload):
    """The payload as text: unpacked and in the charset that the HTTP headers name; what
    does not unpack stays as it is, an unknown charset is read as UTF-8."""
    named = {k.lower(): v for k, v in http.items()}
    for coding in reversed(named.get("content-encoding", "").lower().split(",")):
        if coding.strip() in ("gzip", "x-gzip", "deflate"):
            for bits in (47, -15):
                try:
                    payload = zlib.decompressobj(bits).decompress(payload)
                    break
                except zlib.error:
                    pass
    charset = CHARSET.search(named.get("content-type", ""))
    try:
        return payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive(headers, block):
    """The metadata and the conversion record of one response: ``[(headers, text)]``."""
    own = headers.get("WARC-Record-ID") or record_id("response", digest(block))
    status, http, payload = split_http(block)
    page = decoded(http, payload)
    found = digest(payload)
    ids = {kind: record_id(kind, own, found) for kind in ("metadata", "conversion")}
    title = TITLE.search(page)
    body = json.dumps(
        {
            "source": {k: headers[k] for k in sorted(headers)},
            "status": status,
            "http": {k: http[k] for k in sorted(http)},
            "payload": {"length": len(payload), "digest": found},
            "title": " ".join(title[1].split()) if title else None,
            "links": LINK.findall(page),
        },
        ensure_ascii=False,
    )
    text = "\n".join(t for t, _ in lines_of(page))
    out = []
    for kind, other, content, mime in (
        ("metadata", "conversion", body, "application/json"),
        ("conversion", "metadata", text, "text/plain; charset=utf-8"),
    ):
        raw = content.encode()
        made = {
            "WARC-Type": kind,
            "WARC-Record-ID": ids[kind],
            "WARC-Refers-To": own,
            "WARC-Concurrent-To": ids[other],
            "WARC-Target-URI": headers.get("WARC-Target-URI"),
            "WARC-Date": headers.get("WARC-Date"),
            "WARC-Source-Payload-Digest": headers.get("WARC-Payload-Digest") or found,
            "WARC-Block-Digest": digest(raw),
            "Content-Type": mime,
            "Content-Length": str(len(raw)),
        }
        out.append(({k: v for k, v in made.items() if v is not None}, content))
    return out


HEADERS = T.MapType(T.StringType(), T.StringType())
ARROW_HEADERS = pa.map_(pa.string(), pa.string())


def derivatives(responses, keep=()):
    """``headers map, block binary`` (and ``keep``) -> ``keep, headers, content``, two rows each."""
    keep = list(keep)
    rows = responses.where(F.col("headers")["WARC-Type"] == "response").select(*keep, "headers", "block")
    schema = T.StructType([*[rows.schema[k] for k in keep], T.StructField("headers", HEADERS), T.StructField("content", T.StringType())])

    def run(batches):
        for batch in batches:
            headers, blocks = batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()
            made = [r for h, b in zip(headers, blocks) for r in derive(dict(h), b or b"")]
            twice = pa.array([i for i in range(len(blocks)) for _ in (0, 1)], pa.int64())
            columns = [batch.column(k).take(twice) for k in range(len(keep))]
            columns += [pa.array([list(h.items()) for h, _ in made], ARROW_HEADERS), pa.array([t for _, t in made], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "headers", "content"])

    return rows.mapInArrow(run, schema)


def responses_of(pages, url="url", page="html", date=FETCHED, keep=()):
    """Pages as response records, as a crawler would have stored them."""
    keep = list(keep)
    rows = pages.select(*[F.col(k).alias(k) for k in keep], F.col(url).alias("_url"), F.coalesce(F.col(page), F.lit("")).alias("_page"))
    schema = T.StructType([*[rows.schema[k] for k in keep], T.StructField("headers", HEADERS), T.StructField("block", T.BinaryType())])

    def run(batches):
        for batch in batches:
            urls, pages = batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()
            headers, blocks = [], []
            for u, p in zip(urls, pages):
                raw = p.encode()
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}{END}".encode() + raw
                made = {
                    "WARC-Type": "response",
                    "WARC-Record-ID": record_id("response", u or "", digest(block)),
                    "WARC-Target-URI": u,
                    "WARC-Date": date,
                    "WARC-Payload-Digest": digest(raw),
                    "WARC-Block-Digest": digest(block),
                    "Content-Type": "application/http; msgtype=response",
                    "Content-Length": str(len(block)),
                }
                headers.append([(k, v) for k, v in made.items() if v is not None])
                blocks.append(block)
            columns = [batch.column(k) for k in range(len(keep))]
            columns += [pa.array(headers, ARROW_HEADERS), pa.array(blocks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "headers", "block"])

    return rows.mapInArrow(run, schema)


def write_records(records, path, block="content"):
    """``headers, block`` as text files of WARC records."""
    names = F.concat_ws("\r\n", F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"])))
    text = F.concat(F.lit(VERSION), names, F.lit(END), F.col(block).cast("string"))
    records.select(text.alias("value")).write.option("lineSep", END).text(path)


def read_records(spark, path):
    """``headers, block, complete`` of WARC files of version 1.0 or 1.1; plain files are
    split between records, files whose name ends in ``.gz`` are unpacked and read by one task.

    A block that itself holds the mark between two records is cut there; ``complete`` is
    then false, as its length differs from the header's.
    """
    raw = spark.read.option("lineSep", END + VERSION[:-3]).text(path).where("value <> ''")
    whole = F.regexp_replace("value", r"^(?:WARC/1\.)?[01]\r\n", "")
    cut = F.instr("_whole", END)
    lines = F.split(F.substring("_whole", F.lit(1), F.col("_cut") - 1), "\r\n")
    headers = F.map_from_entries(
        F.transform(lines, lambda s: F.struct(F.substring_index(s, ": ", 1).alias("k"), F.substring(s, F.instr(s, ": ") + 2, F.length(s)).alias("v")))
    )
    rows = raw.withColumn("_whole", whole).withColumn("_cut", cut).withColumn("headers", headers)
    block = F.substring("_whole", F.col("_cut") + 4, F.length("_whole"))
    # the last record of a file keeps its end mark
    size = F.col("headers")["Content-Length"].cast("long")
    data = block.cast("binary")
    rows = rows.withColumn("_data", data)
    rows = rows.withColumn("block", F.when(F.octet_length("_data") == size + 4, F.substring("_data", F.lit(1), size.cast("int"))).otherwise(F.col("_data")))
    return rows.select("headers", "block", (F.octet_length("block") == size).alias("complete"))


@register("op8_warc_derivatives")
def op8_warc_derivatives(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    made = derivatives(responses_of(pages, keep=["page_id"]), keep=["page_id"])
    name = lambda n: F.col("headers")[n]
    return made.select(
        "page_id",
        name("WARC-Type").alias("warc_type"),
        name("WARC-Record-ID").alias("record_id"),
        name("WARC-Refers-To").alias("refers_to"),
        name("WARC-Concurrent-To").alias("concurrent_to"),
        name("WARC-Target-URI").alias("target_uri"),
        name("WARC-Date").alias("warc_date"),
        name("WARC-Source-Payload-Digest").alias("source_payload_digest"),
        name("WARC-Block-Digest").alias("block_digest"),
        name("Content-Length").cast("long").alias("content_length"),
        "content",
    )
