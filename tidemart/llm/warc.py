"""WARC archives: writing captures, reading records, assembling transactions.

``write_archive`` gives every row three records - request, response (or
revisit) and metadata - which name each other by WARC-Concurrent-To. Of rows
with equal payloads of at least ``least_bytes`` bytes the one with the smallest
id is the response and the others revisit it. ``read_archive`` reads any WARC
files as one row per record. ``assemble`` joins request, response and metadata
records through their concurrent-to identifiers, named from either side or over
one record in between, into one nested row per capture.

Both directions use Spark's text source: a record ends with CR LF CR LF, which
is the writer's line separator, and begins with "WARC/1.", the reader's. A
payload that holds that marker is cut by it. A file all of whose fragments are
exactly as long as their Content-Length says needs nothing more (its first
record starts the file, and each ends where the next begins); the fragments of
other files are walked in order, by lengths alone, and put together again.

Scale: files of any size are read by splits (compressed ones by one task each);
a task holds one record. The walk holds the lengths of one file's fragments.
Looking up a payload's first row, a link's record and a revisit's response are
joins with a unique side; keys that hold over a thousandth of the rows are
looked up by broadcast (fewer than a thousand of them), so a payload or a record
that a third of all rows name is spread over all tasks. Record ids come from a
written table, so a task run again writes the same records.

Defined cases: a null payload is empty; a null url gives no WARC-Target-URI
(null when read); null ids come last, and a group of equal payloads without any
id has one response and revisits whose ``refers_to`` id is null; of repeated
rows with the smallest id one is the response. An empty table gives an empty
archive and no rows. Columns other than id, url and payload are ignored. When
reading, a record cut off at the end of a file has ``complete`` false; a request
or metadata record that leads to no response is a capture of its own without
one; a capture with several requests or metadata records shows the one with the
smallest record id and their number.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import lookup, write_and_read
from tidemart.session import share_code

BREAK = "\r\n"
GAP = BREAK + BREAK
MARK = "WARC/1."
CAPTURES = ("response", "revisit", "resource")


def write_archive(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  least_bytes: int = 100, date: str | None = None, compression: str = "gzip") -> None:
    """Write one transaction per row as WARC records below ``path`` (any file system of Spark's)."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload"), "digest": F.sha2(F.col("payload").cast("binary"), 256),
                             "row": F.monotonically_increasing_id()})
    rows = write_and_read(rows.withColumn("shared", F.when(F.col("bytes") >= least_bytes, F.col("digest"))), "warc-rows")
    firsts = rows.where("shared is not null").groupBy(F.col("shared").alias("key__")).agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1").select("key__", F.col("first.row").alias("first"))
    server = r"^[A-Za-z][^:/?#]*://"
    known = lookup(rows, firsts, "shared").withColumns({
        "revisit": F.coalesce(F.col("first") != F.col("row"), F.lit(False)),
        "uri": F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"),
        "request_id": record_name(run, "row", "request"), "response_id": record_name(run, "row", "response"),
        "metadata_id": record_name(run, "row", "metadata"), "refers_to": record_name(run, "first", "response")})
    target = F.regexp_replace("uri", f"{server}[^/?#]*|#.*$", "")
    host = F.regexp_extract("uri", f"{server}([^/?#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(target != "", target).otherwise("/"), F.lit(f" HTTP/1.1{BREAK}Host: "),
                       F.coalesce(host, F.lit("")), F.lit(GAP))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
                      F.col("bytes").cast("string"), F.lit(GAP), F.when(F.col("revisit"), "").otherwise(F.col("payload")))
    known = known.withColumns({"request": request, "answer": answer, "told": F.to_json(F.struct("id", "url"))})

    def record(kind: str, block: str, headers: dict[str, Column]) -> Column:
        lines = [F.concat(F.lit(f"{k}: "), v) for k, v in {
            **headers, "WARC-Date": F.lit(date), "WARC-Target-URI": F.col("uri"),
            "Content-Length": F.octet_length(block).cast("string")}.items()]
        return F.concat(F.lit(f"{MARK}1{BREAK}WARC-Type: {kind}{BREAK}"), F.concat_ws(BREAK, *lines), F.lit(GAP),
                        F.col(block))  # a null value gives no line

    beside = {"WARC-Concurrent-To": F.col("response_id")}
    http = "application/http;msgtype="
    main = {"WARC-Record-ID": F.col("response_id"), "WARC-Payload-Digest": F.concat(F.lit("sha256:"), "digest"),
            "Content-Type": F.lit(f"{http}response")}
    again = {"WARC-Refers-To": F.col("refers_to"),
             "WARC-Profile": F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")}
    records = F.array(
        record("request", "request", {"WARC-Record-ID": F.col("request_id"), "Content-Type": F.lit(f"{http}request"), **beside}),
        F.when(F.col("revisit"), record("revisit", "answer", main | again)).otherwise(record("response", "answer", main)),
        record("metadata", "told", {"WARC-Record-ID": F.col("metadata_id"), "Content-Type": F.lit("application/json"), **beside}))
    writer = known.select(F.explode(records).alias("value")).write.option("lineSep", GAP)
    writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED").text(path)


def record_name(run: str, row: str, kind: str) -> Column:
    """A record id that depends on the run, the written row's number and the kind alone."""
    h = F.md5(F.concat_ws("-", F.lit(run), F.col(row).cast("string"), F.lit(kind)).cast("binary"))
    at = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    named = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, s, n) for s, n in at]), F.lit(">"))
    return F.when(F.col(row).isNotNull(), named)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record: record_id, type, date, uri, concurrent_to, refers_to, digest, content_type, complete,
    http_head, payload_bytes, payload_digest and block.

    Without ``payload`` the block of responses is left out (null), their bytes
    and digest are taken all the same, and the rows are written once.
    """
    parts = fragments(spark, path)
    read = records_of(parts, payload)
    if payload:
        cut = parts.where(~exact()).select("file").distinct()
    else:
        read = write_and_read(read, "warc-records")
        cut = read.where("not exact").select("file").distinct()
    files = [r["file"] for r in cut.collect()]  # at most the file names that the driver has listed to plan the scan
    if files:
        broken = write_and_read(parts.where(F.col("file").isin(files)).withColumn(
            "part", F.monotonically_increasing_id()), "warc-fragments")
        read = read.where(~F.col("file").isin(files)).unionByName(records_of(put_together(broken), payload))
    return read.where("head").drop("head", "file", "exact")


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two markers, its header lines (null where it begins with none), its file and split."""
    text = spark.read.option("lineSep", MARK).text(path)
    begins = F.substring("value", 1, 24).rlike(r"^[0-9]+\r\n[A-Za-z]") & F.contains(F.col("value"), F.lit(GAP))
    folded = F.regexp_replace(F.substring_index("value", GAP, 1), r"\r\n[ \t]+", " ")
    return text.select("value", F.when(begins, folded).alias("lines"),
                       F.when(begins, F.octet_length(F.substring_index("value", GAP, 1)) + len(GAP)).alias("start"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def field(name: str) -> Column:
    """Text of the first header field of a name; null where there is none."""
    found = F.trim(F.regexp_extract("lines", rf"(?i)\r\n{name}:([^\r\n]*)", 1))
    return F.when(found != "", found)


def length() -> Column:
    return field("content-length").try_cast("long")


def exact() -> Column:
    """Whether a fragment is one whole record: nothing but line breaks after its block. An empty one is no record."""
    end = F.col("start") + length()
    after = F.substring(F.col("value").cast("binary"), (end + 1).cast("int"), F.octet_length("value")).cast("string")
    whole = (F.octet_length("value") >= end) & (F.octet_length("value") - end <= 64) & after.rlike(r"^[\r\n]*$")
    return (F.col("value") == "") | F.coalesce(whole, F.lit(False))


def identifier(text: Column) -> Column:
    return F.regexp_replace(text, "^<|>$", "")


def records_of(parts: DataFrame, payload: bool) -> DataFrame:
    raw = F.col("value").cast("binary")
    links = F.regexp_extract_all("lines", F.lit(r"(?i)\r\nwarc-concurrent-to:([^\r\n]*)"), F.lit(1))
    read = parts.select(
        "file", exact().alias("exact"), F.col("lines").isNotNull().alias("head"),
        identifier(field("warc-record-id")).alias("record_id"), F.lower(field("warc-type")).alias("type"),
        field("warc-date").alias("date"), field("warc-target-uri").alias("uri"),
        F.transform(links, lambda x: identifier(F.trim(x))).alias("concurrent_to"),
        identifier(field("warc-refers-to")).alias("refers_to"), field("warc-payload-digest").alias("digest"),
        field("content-type").alias("content_type"), length().alias("length"), F.octet_length("value").alias("size"),
        F.substring(raw, F.col("start") + 1, F.coalesce(length(), F.lit(0)).cast("int")).alias("block"), "start")
    http = F.coalesce(F.col("content_type").startswith("application/http"), F.lit(False))
    read = read.withColumn("http_head", F.when(http, F.substring_index(F.col("block").cast("string"), GAP, 1)))
    body = F.when(http, F.substring("block", F.octet_length("http_head") + len(GAP) + 1, F.octet_length("block"))
                  ).otherwise(F.col("block"))
    stated = F.regexp_extract("http_head", r"(?i)\r\ncontent-length: *([0-9]+)", 1).try_cast("long")
    told = F.when(F.col("digest").startswith("sha256:"), F.substring_index("digest", ":", -1))
    revisit, capture = F.col("type") == "revisit", F.col("type").isin(*CAPTURES)
    return read.select(
        "file", "exact", "head", "record_id", "type", "date", "uri", "concurrent_to", "refers_to", "digest", "content_type",
        F.coalesce(F.col("size") >= F.col("start") + F.col("length"), F.lit(False)).alias("complete"), "http_head",
        F.when(revisit, stated).when(capture, F.octet_length(body).cast("long")).alias("payload_bytes"),
        F.when(revisit, told).when(capture, F.sha2(body, 256)).alias("payload_digest"),
        (F.col("block") if payload else F.when(~capture, F.col("block"))).alias("block"))


def put_together(parts: DataFrame) -> DataFrame:
    """Fragments of files that hold the marker inside records: the walk over lengths, then the pieces of each record."""
    share_code(parts.sparkSession)
    sizes = parts.select("file", "split", "part", F.octet_length("value").cast("long").alias("size"),
                         (F.col("start") + length()).alias("needed"))
    owned = sizes.groupBy("file").applyInPandas(walk, "part long, owner long")
    pieces = parts.select(F.col("part").alias("piece"), "split", "value").join(owned, F.col("piece") == F.col("part"))
    ordered = F.array_sort(F.collect_list(F.struct("split", "piece", "value")))
    whole = pieces.groupBy("owner").agg(F.array_join(F.transform(ordered, lambda p: p["value"]), MARK).alias("value"))
    heads = parts.select("part", "lines", "start", "file", "split")  # those of a record's first fragment
    return whole.join(heads, F.col("owner") == F.col("part")).select("value", "lines", "start", "file", "split")


def walk(sizes: pd.DataFrame) -> pd.DataFrame:
    """The first fragment of each fragment's record, one file in order; fragments outside of records go."""
    sizes = sizes.sort_values(["split", "part"])
    part, owner, first, missing = [], [], 0, 0
    for p, size, need in zip(sizes["part"], sizes["size"], sizes["needed"]):
        if missing > 0:
            missing -= size + len(MARK)
        elif need == need and need is not None:
            first, missing = p, need - size
        else:
            continue
        part.append(p)
        owner.append(first)
    return pd.DataFrame({"part": part, "owner": owner}, dtype="int64")


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, uri, date, response, request, metadata, n_requests, n_metadata."""
    named = records.where("record_id is not null")
    ids = write_and_read(named.select("record_id", F.col("type").isin(*CAPTURES).alias("capture"), "concurrent_to"),
                         "warc-ids")
    said = ids.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    links = write_and_read(said.unionByName(said.select(F.col("b").alias("a"), F.col("a").alias("b"))), "warc-links")
    anchors = ids.where("capture").select(F.col("record_id").alias("key__")).distinct().withColumn("to", F.col("key__"))
    others = ids.where("not capture").select(F.col("record_id").alias("a")).distinct()
    near = lookup(links, anchors, "b").where("to is not null").groupBy("a").agg(F.min("to").alias("to"))
    near = write_and_read(near.join(others, "a"), "warc-near")
    open_links = write_and_read(links.join(near.select("a"), "a", "left_anti").join(others, "a"), "warc-open")
    far = lookup(open_links, near.select(F.col("a").alias("key__"), "to"), "b").where("to is not null")
    belongs = near.unionByName(far.groupBy("a").agg(F.min("to").alias("to")))

    beside = named.where(F.col("type").isin("request", "metadata")).join(belongs, F.col("record_id") == F.col("a"), "left")
    beside = beside.withColumn("to", F.coalesce("to", "record_id"))
    about = {}
    for kind in ("request", "metadata"):
        one = F.col("type") == kind
        about[kind] = F.min_by(F.when(one, F.struct("record_id", "content_type", "block")),
                               F.when(one, F.col("record_id"))).alias(kind)
        about[f"n_{kind}"] = F.sum(one.cast("long")).alias("n_requests" if kind == "request" else "n_metadata")
    beside = beside.groupBy("to").agg(*about.values(), F.min("uri").alias("other_uri"), F.min("date").alias("other_date"))

    body = F.when(F.col("http_head").isNotNull(), F.substring(
        "block", F.octet_length("http_head") + len(GAP) + 1, F.octet_length("block"))).otherwise(F.col("block"))
    response = F.struct("record_id", "type", "refers_to", "http_head", "complete", "payload_bytes", "payload_digest",
                        body.alias("payload"))
    main = named.where(F.col("type").isin(*CAPTURES)).select("record_id", "uri", "date", response.alias("response"))
    joined = main.join(beside, F.col("record_id") == F.col("to"), "full_outer")
    return joined.select(
        F.coalesce("record_id", "to").alias("capture_id"), F.coalesce("uri", "other_uri").alias("uri"),
        F.coalesce("date", "other_date").alias("date"), "response", "request", "metadata",
        F.coalesce("n_requests", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"))


def round_trip(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least_bytes: int = 100) -> DataFrame:
    """Write ``df`` below ``path`` and read it back: id, url, payload_bytes, payload_digest, record_type, refers_to (an id)."""
    write_archive(df, path, id_col, url_col, payload_col, least_bytes)
    captures = assemble(read_archive(df.sparkSession, path, payload=False))
    kept = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).schema
    told = F.from_json(F.col("metadata.block").cast("string"), kept)
    found = write_and_read(captures.select(
        told.alias("told"), F.col("response.record_id").alias("record_id"),
        F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("of_record")).select(
        "told.*", "record_id", "payload_bytes", "payload_digest", "record_type", "of_record"), "warc-captures")
    firsts = found.where("record_type = 'response'").select(F.col("record_id").alias("key__"), F.col("id").alias("refers_to"))
    out = lookup(found, firsts, "of_record")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "payload_bytes", "payload_digest",
                      "record_type", "refers_to")
