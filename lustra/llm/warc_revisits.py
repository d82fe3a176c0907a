"""Web archives without repeated payloads: later captures of a payload become revisit records.

Records are written by Spark's text writer as gzipped WARC/1.1, headers and block in one
value, so archives can lie in any store that Spark writes to. An archive names a random
boundary in the first header line of every record; with it the text reader cuts files into
records while it streams them, and a payload can't look like a record's beginning. The
declared length is checked against every record read.

Which records are revisits is settled from headers alone: they are shuffled by payload
digest and payloads stay where they are. Then the records are read once more and written
with fresh headers, revisits without their payloads but with references to the
original. Reading resolves revisits by joining them to the originals they refer to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lustra.llm.stored import stored

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK_TYPE = "application/http; msgtype=response"
_CRLF = "\r\n"
_GAP = _CRLF + _CRLF
_BOUNDARY = "Archive-Boundary: "

#: Rows of revisit decisions or originals up to which they are broadcast, a few hundred bytes each.
_SMALL_ROWS = 50_000
#: More rows than this under one key are joined by broadcast; there are at most 4096 such keys.
_HOT_ROWS = 1000
_HOT_KEYS = 4096


def many_to_one(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Left join of rows to at most one row a key, where a key may have any share of the rows.

    Keys with more than ``_HOT_ROWS`` rows and more than a 4096th of all go by
    broadcast, so their rows stay where they are; the others are shuffled by key.
    """
    counts = many.filter(F.col(key).isNotNull()).groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = stored(counts.filter(F.col("count") > max(_HOT_ROWS, total // _HOT_KEYS)).select(key), "hot")
    if hot.isEmpty():
        return many.join(one, key, "left")
    heavy = F.broadcast(hot.withColumn("hot", F.lit(True)))
    told = many.join(heavy, key, "left")
    few = F.broadcast(one.join(F.broadcast(hot), key, "left_semi"))
    apart = told.filter("hot").drop("hot").join(few, key, "left")
    return told.filter("hot IS NULL").drop("hot").join(one, key, "left").unionByName(apart)


# --- writing -----------------------------------------------------------------------


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL. Line ends and blanks in a value are percent-encoded."""
    safe = value.cast("string")
    for plain, coded in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")):
        safe = F.replace(safe, F.lit(plain), F.lit(coded))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(_CRLF)), F.lit(""))


def _utc(at: str) -> Column:
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _urn(name: Column) -> Column:
    """A record id settled by a name."""
    h = F.sha2(name, 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _write(records: DataFrame, folder: str, boundary: str) -> None:
    """``records``: record_type, record_id, date, uri, page_id, payload, digest, refers_* of revisits."""
    revisit = F.col("record_type") == "revisit"
    kept = F.when(revisit, "").otherwise(F.col("payload"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(_GAP),
    )
    lines = F.concat(
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", _utc("date")),
        _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}{_CRLF}")).otherwise(""),
        _line("WARC-Refers-To", F.col("refers_to_id")),
        _line("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        _line("WARC-Refers-To-Date", F.col("refers_to_date")),
        _line("Page-Id", F.col("page_id")),
        F.lit(f"Content-Type: {BLOCK_TYPE}{_CRLF}"),
    )
    block = records.select(lines.alias("lines"), F.concat(http, kept).alias("block"))
    begun = f"{VERSION}{_CRLF}{_BOUNDARY}{boundary}{_CRLF}"
    length = F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string"))
    value = F.concat(F.lit(begun), "lines", length, F.lit(_GAP), "block")
    block.select(value.alias("value")).write.option("lineSep", _GAP).option("compression", "gzip").text(folder)


def write_archives(pages: DataFrame, folder: str) -> None:
    """A response record for every page: its html, as UTF-8, is the payload.

    Needs ``page_id``, ``url``, ``html``; a timestamp ``fetched_at`` is the capture's date,
    else it is now. Other columns are left behind. A NULL html is an empty payload; a NULL url or page_id leaves
    its header line out. Rows that repeat get a record each. Without pages there are no
    records. The longest html sets what a task holds. A task of the scan writes one file, gzipped as
    a whole.
    """
    date = F.col("fetched_at").cast("timestamp") if "fetched_at" in pages.columns else F.current_timestamp()
    payload = F.coalesce(F.col("html"), F.lit(""))
    records = pages.select(
        F.lit("response").alias("record_type"),
        F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")).alias("record_id"),
        date.alias("date"),
        F.col("url").alias("uri"),
        "page_id",
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        *(F.lit(None).cast("string").alias(c) for c in ("refers_to_id", "refers_to_uri", "refers_to_date")),
    )
    _write(records, folder, uuid.uuid4().hex)


# --- reading -----------------------------------------------------------------------


def _boundary_of(spark: SparkSession, folder: str) -> str | None:
    """The second line of the first record; no more than the head of one file is read."""
    heads = spark.read.text(folder).filter(F.col("value").startswith(_BOUNDARY)).take(1)
    return heads[0][0].removeprefix(_BOUNDARY).strip() if heads else None


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records of one folder of archives, as :func:`write_archives` or :func:`deduplicate` wrote it.

    Columns: record_type, record_id, date, uri, page_id, payload_digest (as declared),
    http_length (of the payload when it was fetched), refers_to_id, payload. A record of another length than it
    declares, or a payload other than its digest, raises: a torn file is never read as
    something shorter. An archive without records gives no rows.
    """
    boundary = _boundary_of(spark, folder)
    begun = f"{VERSION}{_CRLF}{_BOUNDARY}{boundary}{_CRLF}"
    pieces = spark.read.option("lineSep", begun).text(folder).filter(F.col("value") != "")
    head = F.substring_index("value", _GAP, 1)
    parted = pieces.select(F.concat(F.lit("\n"), head, F.lit("\r")).alias("head"), F.col("value").cast("binary").alias("raw"))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?i)\n{name}: *([^\r\n]*)\r", 1)
        return F.when(found != "", found)

    # The line feed and return put around the head make up for the one byte each counts more.
    start = F.octet_length("head") - 2 + len(_GAP)
    length = field("Content-Length").cast("int")
    whole = F.octet_length("raw") == start + length + len(_GAP)
    block = F.expr(f"CAST(substring(raw, octet_length(head) - 2 + {len(_GAP)} + 1, declared) AS STRING)")
    read = parted.withColumns({"declared": length, "whole": whole}).withColumn("block", block)
    http = F.substring_index("block", _GAP, 1)
    payload = F.expr(f"substring(block, char_length(http) + {len(_GAP)} + 1)")
    read = read.withColumn("http", http).withColumn("payload", payload)
    torn = F.raise_error(F.concat(F.lit("torn record "), F.coalesce(field("WARC-Record-ID"), F.lit("?"))))
    digest = F.substring_index(field("WARC-Payload-Digest"), ":", -1)
    intact = F.col("whole") & ((field("WARC-Type") != "response") | (F.sha2("payload", 256) == digest))
    return read.select(
        F.when(F.coalesce(intact, F.lit(False)), field("WARC-Type")).otherwise(torn.cast("string")).alias("record_type"),
        field("WARC-Record-ID").alias("record_id"),
        F.to_timestamp(field("WARC-Date")).alias("date"),
        field("WARC-Target-URI").alias("uri"),
        field("Page-Id").cast("long").alias("page_id"),
        digest.alias("payload_digest"),
        F.regexp_extract("http", r"(?i)\nContent-Length: *(\d+)", 1).cast("long").alias("http_length"),
        field("WARC-Refers-To").alias("refers_to_id"),
        "payload",
    )


# --- revisits ------------------------------------------------------------------------


def originals(headers: DataFrame, least_bytes: int) -> DataFrame:
    """For each digest that several long payloads have, its first record: least page_id (NULL last), then record id."""
    first = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "record_id", "uri", "date")
    same = headers.filter(F.col("http_length") >= least_bytes).groupBy("payload_digest")
    found = same.agg(F.count("*").alias("n"), F.min(first).alias("first"))
    return found.filter("n > 1").select("payload_digest", "first")


def deduplicate(spark: SparkSession, source: str, target: str, least_bytes: int = 100) -> None:
    """Write the archives of one folder anew, with revisit records for payloads met before.

    Of responses with equal payloads of ``least_bytes`` or more, the one with the
    least page_id stays a response (repeated page_ids: the one with the least record id; a NULL
    one comes last); the others refer to it. Shorter payloads stay as they are.
    Every record gets a new id, settled by its old one and the new archive, so references
    can be written before the records they point to are.

    The headers are shuffled, by digest; whole records only if the revisits are too many to
    be broadcast. Then each is one row of a shuffle by record id.
    """
    records = read_archives(spark, source)
    headers = stored(records.drop("payload", "refers_to_id"), "headers")
    firsts = stored(originals(headers, least_bytes), "originals")
    copies = headers.filter(F.col("http_length") >= least_bytes).select("record_id", "payload_digest")
    if firsts.isEmpty():
        copies = copies.limit(0)
    revisits = many_to_one(copies, firsts, "payload_digest").filter(F.col("first.record_id") != F.col("record_id"))
    revisits = stored(revisits.select("record_id", "first"), "revisits")
    small = revisits.count() <= _SMALL_ROWS
    boundary = uuid.uuid4().hex
    told = records.join(F.broadcast(revisits) if small else revisits, "record_id", "left")

    def fresh(old: str) -> Column:
        return _urn(F.concat(F.lit(f"{boundary} "), F.col(old)))

    again = F.col("first").isNotNull()
    rewritten = told.select(
        F.when(again, "revisit").otherwise(F.col("record_type")).alias("record_type"),
        fresh("record_id").alias("record_id"),
        "date",
        "uri",
        "page_id",
        "payload",
        F.col("payload_digest").alias("digest"),
        F.when(again, fresh("first.record_id")).alias("refers_to_id"),
        F.when(again, F.col("first.uri")).alias("refers_to_uri"),
        F.when(again, _utc("first.date")).alias("refers_to_date"),
    )
    _write(rewritten, target, boundary)


def resolved(records: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record with what it stands for: revisits take digest, length and payload from the original.

    Returns page_id, payload_bytes, payload_digest (of the payload there is, computed
    anew), record_type, refers_to (the original's page_id) and with ``with_payload`` the payload. A
    revisit whose original is missing has NULLs there. Payloads are shuffled only if
    asked for.
    """
    own = records.select(
        "page_id",
        "record_type",
        "record_id",
        "refers_to_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        *(["payload"] if with_payload else []),
    )
    own = stored(own, "records")
    responses = own.filter(F.col("record_type") != "revisit")
    found = ["payload_bytes", "payload_digest", *(["payload"] if with_payload else [])]
    one = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), *found)
    again = own.filter(F.col("record_type") == "revisit").select("page_id", "record_type", "refers_to_id")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *found[2:]]
    plain = responses.withColumn("refers_to", F.lit(None).cast("long"))
    if again.isEmpty():
        return plain.select(*columns)
    needed = one.join(again.select("refers_to_id").distinct(), "refers_to_id", "left_semi")
    return plain.select(*columns).unionByName(many_to_one(again, needed, "refers_to_id").select(*columns))


def oracle_sql() -> str:
    """Records of ``pages`` after the round trip."""
    return """
SELECT page_id, n AS payload_bytes, h AS payload_digest,
 CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h,
 min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages) AS p"""
