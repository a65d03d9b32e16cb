"""WARC archives: records of a crawl, and the assembly of its transactions.

``page_records`` turns pages into request, response (or revisit) and metadata
records. ``write_archive`` writes records as gzipped WARC/1.1 files through
Spark's committer, with a bounded number of records a file. ``read_archive``
reads such files back, each record cut by its Content-Length, so a payload may
hold anything, the version line of a record included. ``assemble`` joins the
records of a capture through their WARC-Concurrent-To identifiers, in either
direction and through one further record, and emits one nested row a capture.

Payloads of at least ``revisit_bytes`` bytes that are equal (by SHA-1 and
length) share one response, that of the largest page_id; the other pages
become revisit records without a body that refer to it.

Defined cases: a null html is an empty payload; a null url an empty target;
line breaks in a url are percent-encoded; pages with a null page_id never
serve as the response that others refer to while another page has the same
payload; rows that repeat the largest page_id with the same payload are all
responses; repeated pages give captures of their own, as each row has its own
record ids. Request or metadata records that no capture can be found for are
left out by ``assemble``. An empty table gives an empty archive, and that an
empty result. Other columns of the pages are ignored.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Smallest payload that a revisit record may stand for; records a file; parts that one payload's pages are spread over.
REVISIT_BYTES, RECORDS_PER_FILE, SALTS = 1000, 3000, 32
DATE = "2024-01-01T00:00:00Z"
RECORD_SCHEMA = "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, date string, payload_digest string, payload_bytes bigint, fields map<string,string>, payload binary"
_END = "\r\n"


def _bytes(c: Column) -> Column:
    return F.octet_length(c).cast("bigint")


def _head(*lines: tuple[str, Column | str | None]) -> Column:
    """Header lines; those with a null value are left out."""
    return F.concat(F.lit("WARC/1.1" + _END), *[F.coalesce(F.concat(F.lit(f"{k}: "), F.lit(v) if isinstance(v, str) else v, F.lit(_END)), F.lit("")) for k, v in lines], F.lit(_END))


def page_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """One column ``record``: the texts of the records of each page, three a page."""
    uri = F.regexp_replace(F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), uri.alias("uri"), F.coalesce(F.col("html"), F.lit("")).alias("body"))
    base = base.select("*", _bytes(F.col("body")).alias("size"), F.sha1("body").alias("digest"), F.md5(F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.monotonically_increasing_id().cast("string"))).alias("uid"))

    # the response of each payload that occurs more than once: sums per task come first, so a hot payload is no hot task
    large = base.filter(F.col("size") >= revisit_bytes)
    first = (
        large.groupBy("digest", "size")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("first_id"), F.max_by("uid", F.struct("page_id", "uid")).alias("first_uid"))
        .filter("n > 1 and first_id is not null")
        .select("digest", "size", "first_id", "first_uid", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = base.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
    rows = salted.join(first, ["digest", "size", "salt"], "left")
    revisit = F.coalesce(F.col("page_id") < F.col("first_id"), F.col("first_id").isNotNull())
    rows = rows.withColumn("revisit", revisit)

    rid = lambda kind: F.concat(F.lit(f"<urn:{kind}:"), F.col("uid"), F.lit(">"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    host = F.regexp_extract("uri", "://([^/?#]*)", 1)
    ask = F.concat(F.lit("GET "), F.col("uri"), F.lit(f" HTTP/1.1{_END}Host: "), host, F.lit(_END + _END))
    request = F.concat(
        _head(("WARC-Type", "request"), ("WARC-Record-ID", rid("request")), ("WARC-Date", DATE), ("WARC-Target-URI", F.col("uri")), ("WARC-Concurrent-To", rid("capture")), ("Content-Type", "application/http; msgtype=request"), ("Content-Length", _bytes(ask).cast("string"))),
        ask, F.lit(_END + _END),
    )
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("size").cast("string"), F.lit(_END + _END))
    block = F.concat(answer, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("body")))
    capture = F.concat(
        _head(
            ("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", rid("capture")), ("WARC-Date", DATE), ("WARC-Target-URI", F.col("uri")),
            ("WARC-Concurrent-To", rid("request")), ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("WARC-Refers-To", F.when(F.col("revisit"), F.concat(F.lit("<urn:capture:"), F.col("first_uid"), F.lit(">")))),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", _bytes(block).cast("string")),
        ),
        block, F.lit(_END + _END),
    )
    told = F.concat(*[F.coalesce(F.concat(F.lit(f"{k}: "), c.cast("string"), F.lit(_END)), F.lit("")) for k, c in (("page_id", F.col("page_id")), ("payload_bytes", F.col("size")), ("refers_to_page_id", F.when(F.col("revisit"), F.col("first_id"))))])
    metadata = F.concat(
        _head(("WARC-Type", "metadata"), ("WARC-Record-ID", rid("metadata")), ("WARC-Date", DATE), ("WARC-Target-URI", F.col("uri")), ("WARC-Concurrent-To", rid("request")), ("Content-Type", "application/warc-fields"), ("Content-Length", _bytes(told).cast("string"))),
        told, F.lit(_END + _END),
    )
    return rows.select(F.explode(F.array(request, capture, metadata)).alias("record"))


def write_archive(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Writes the texts of ``record`` one after another; each ends with a line break, which the writer adds."""
    records.select(F.expr("substring(record, 1, length(record) - 1)").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


def parse_records(data: bytes):
    """(headers, block) of each record of an archive file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        heads: list[tuple[str, str]] = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
        size = int(next(v for k, v in heads if k == "content-length"))
        yield heads, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the archive files under ``path``; without payloads only their sizes and SHA-1 digests are kept."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("content")

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for heads, block in parse_records(gzip.decompress(data.as_py())):
                    h = dict(heads)
                    kind = h.get("warc-type", "")
                    payload = block.partition(b"\r\n\r\n")[2] if h.get("content-type", "").startswith("application/http") else b""
                    has_own = kind == "response"
                    fields = [tuple(x.split(": ", 1)) for x in block.decode("utf-8").split("\r\n") if ": " in x] if kind == "metadata" else []
                    rows.append({
                        "record_id": h.get("warc-record-id"), "record_type": kind, "concurrent_to": [v for k, v in heads if k == "warc-concurrent-to"], "refers_to": h.get("warc-refers-to"),
                        "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date"),
                        "payload_digest": hashlib.sha1(payload).hexdigest() if has_own else h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                        "payload_bytes": len(payload) if has_own else None, "fields": fields, "payload": payload if has_own and with_payload else None,
                    })
                kinds = {"concurrent_to": pa.list_(pa.string()), "payload_bytes": pa.int64(), "fields": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}
                names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
                if rows:
                    yield pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in names})

    return files.mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """capture_id, capture, requests, metadata: one row a response or revisit record.

    A record belongs to the capture that it names as concurrent, or that names
    it, or that a record does which it names or is named by. The lists hold
    what a crawler noted about one transaction, not a corpus-sized group.
    """
    captures = F.col("record_type").isin("response", "revisit")
    named = records.select("record_id", captures.alias("is_capture"), F.explode_outer("concurrent_to").alias("other"))
    # links in both directions, between records that exist
    links = named.filter("other is not null").select(F.col("record_id").alias("a"), F.col("other").alias("b"))
    links = links.union(links.select("b", "a")).distinct()
    heads = records.filter(captures).select(F.col("record_id").alias("a"))
    near = links.join(heads, "a").select(F.col("a").alias("capture_id"), F.col("b").alias("record_id"))
    far = near.select("capture_id", F.col("record_id").alias("a")).join(links, "a").select("capture_id", F.col("b").alias("record_id"))
    member = near.withColumn("d", F.lit(1)).union(far.withColumn("d", F.lit(2))).groupBy("record_id").agg(F.min_by("capture_id", F.struct("d", "capture_id")).alias("capture_id"))
    others = records.filter(~captures).drop("payload").join(member, "record_id")
    inner = F.struct(*[c for c in others.columns if c != "capture_id"])
    parts = others.groupBy("capture_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("record_type") == "request", F.struct("record_id", "target_uri", "date")))).alias("requests"),
        F.collect_list(F.when(F.col("record_type") == "metadata", inner)).alias("metadata"),
    )
    own = records.filter(captures).select(F.col("record_id").alias("capture_id"), F.struct(*records.columns).alias("capture"))
    return own.join(parts, "capture_id", "left")


def page_captures(assembled: DataFrame) -> DataFrame:
    """The digest row of each page: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    fields = F.col("metadata")[0]["fields"]
    return assembled.select(
        fields["page_id"].cast("bigint").alias("page_id"), fields["payload_bytes"].cast("bigint").alias("payload_bytes"), F.col("capture.payload_digest").alias("payload_digest"),
        F.col("capture.record_type").alias("record_type"), fields["refers_to_page_id"].cast("bigint").alias("refers_to"), F.size("requests").alias("n_requests"),
    )
