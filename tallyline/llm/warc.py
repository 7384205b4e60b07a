"""A content-addressed web archive: payload bytes once by digest, exact record headers apart, records through a join."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


#: Characters that some reader takes for a line end, the other control characters, and the sign of an escape.
ODD_CHARS = "%" + "".join(map(chr, [*range(32), 127, 0x85, 0x2028, 0x2029]))
ODD = "[\\x00-\\x1F\\x7F\\x{85}\\x{2028}\\x{2029}]"
URL, EXACT_URL = "WARC-Target-URI", "X-Exact-Target-URI"


def _percent(char: str) -> str:
    return "".join(f"%{b:02X}" for b in char.encode())


def _escaped(value: Column, chars: str = ODD_CHARS) -> Column:
    for char in chars:
        value = F.replace(value, F.lit(char), F.lit(_percent(char)))
    return value


def _unescaped(value: Column) -> Column:
    for char in reversed(ODD_CHARS):
        value = F.replace(value, F.lit(_percent(char)), F.lit(char))
    return value


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value. The value must not hold a line break."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def _url_fields(url: Column) -> Column:
    """The address, odd characters percent-encoded; where it has any, a second field holds it with % encoded too, which can be
    undone."""
    odd = url.rlike(ODD)
    return F.concat(_field(URL, F.when(odd, _escaped(url, ODD_CHARS[1:])).otherwise(url)), _field(EXACT_URL, F.when(odd, _escaped(url))))


def _record_id(*parts: Column) -> Column:
    h = F.md5(F.encode(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])), "UTF-8"))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archive `pages` (page_id, url, html) under `path`: one record per row, in the tables `payloads` and `headers`.

    The payload is the html in UTF-8; null counts as empty. Of the records with equal payloads of at least `min_bytes`
    the one with the smallest page_id is the response (then the smallest url, then any one of equal rows; null comes
    last), the others revisit it. Smaller payloads always make a response. Either way `payloads` holds the bytes once.
    Other columns are not archived. Fails if one digest has two contents.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    (rows.select("digest", "payload").dropDuplicates(["digest"])
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))

    copies = (rows.select("page_id", "url", "digest", F.octet_length("payload").alias("size"),
                          F.xxhash64("payload").alias("other"))
              .groupBy("page_id", "url", "digest", "size", "other").agg(F.count("*").alias("n")))
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("url").isNull(), F.col("url"))
    same = (F.min("size") == F.max("size")) & (F.min("other") == F.max("other"))
    first = copies.groupBy("digest").agg(
        F.min(order).alias("first"),
        F.assert_true(same, F.lit("one digest, two payloads")).alias("checked"))
    of_first = [F.col("first.page_id"), F.col("first.url")]
    records = (copies.join(first, "digest")
               .select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")))
    is_first = F.col("page_id").eqNullSafe(of_first[0]) & F.col("url").eqNullSafe(of_first[1]) & (F.col("copy") == 1)
    response = (F.col("size") < min_bytes) | is_first | F.col("checked").isNotNull()
    own_id = _record_id(F.col("digest"), F.col("page_id"), F.col("url"), F.col("copy"))
    first_id = _record_id(F.col("digest"), *of_first, F.lit(1))
    head = [F.lit(f"WARC/1.1{CRLF}"), _field("WARC-Type", F.when(response, "response").otherwise("revisit")),
            _field("WARC-Record-ID", own_id), _field("WARC-Date", F.lit(date)),
            _url_fields(F.col("url")), _field("X-Page-Id", F.col("page_id")),
            _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"))]
    revisit = [_field("WARC-Profile", F.lit(REVISIT)), _field("WARC-Refers-To", first_id),
               _field("X-Refers-To-Page-Id", of_first[0]), _field("Content-Length", F.lit(0))]
    own = [_field("Content-Type", F.lit("text/html; charset=UTF-8")), _field("Content-Length", F.col("size"))]
    header = F.concat(*head, F.when(response, F.concat(*own)).otherwise(F.concat(*revisit)), F.lit(CRLF))
    (records.select("digest", F.encode(header, "UTF-8").alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))


def _value(name: str, head: Column) -> Column:
    """A field of a header; null where it is not there. Fields are parted by CRLF, which no value holds."""
    found = F.regexp_extract(head, f"(?s)\r\n{name}: (.*?)\r\n", 1)
    return F.when(F.contains(head, F.lit(f"\r\n{name}: ")), found)


def _url(head: Column) -> Column:
    exact = _value(EXACT_URL, head)
    return F.when(exact.isNotNull(), _unescaped(exact)).otherwise(_value(URL, head))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: header fields, payload (also of revisits), its size and digest, and the record's bytes.

    Every stored payload is digested again; a wrong digest or a missing payload fails the read.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    payloads = stored.select(
        "digest", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest"))
        .otherwise(F.raise_error(F.lit("a stored payload does not have its digest"))).alias("payload_digest"))
    head = F.decode("header", "UTF-8")
    headers = spark.read.parquet(f"{path}/headers").select(
        F.substring(_value("WARC-Payload-Digest", head), len("sha256:") + 1, 64).alias("digest"),
        "header", _value("WARC-Type", head).alias("record_type"), _value("WARC-Record-ID", head).alias("record_id"),
        _value("X-Page-Id", head).cast("long").alias("page_id"), _url(head).alias("url"),
        _value("X-Refers-To-Page-Id", head).cast("long").alias("refers_to"),
        _value("WARC-Refers-To", head).alias("refers_to_record"))
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    missing = F.raise_error(F.lit("a record without its payload"))
    return (headers.join(payloads, "digest", "left")
            .withColumn("payload_digest", F.when(F.col("payload_digest").isNull(), missing).otherwise(F.col("payload_digest")))
            .withColumn("record", F.concat("header", body, F.lit(b"\r\n\r\n"))).drop("digest"))


def parse_records(records: DataFrame) -> DataFrame:
    """`records` with page_id, url, record_type, refers_to and payload_digest as the record's own bytes have them, and body_bytes.

    A body that has not the length or, in a response, not the digest that its header states fails the read.
    """
    text = F.decode("record", "UTF-8")
    cut = records.withColumn("_text", text).withColumn("_at", F.instr("_text", CRLF + CRLF))
    parted = cut.withColumn("_head", F.substr("_text", F.lit(1), F.col("_at") + 1)).withColumn(
        "_body", F.encode(F.substr("_text", F.col("_at") + 4, F.char_length("_text") - F.col("_at") - 7), "UTF-8"))
    head, stated = F.col("_head"), _value("WARC-Payload-Digest", F.col("_head"))
    response = _value("WARC-Type", head) == "response"
    whole = (F.octet_length("_body") == _value("Content-Length", head).cast("long")) & (
        ~response | (stated == F.concat(F.lit("sha256:"), F.sha2("_body", 256))))
    fields = {
        "page_id": _value("X-Page-Id", head).cast("long"), "url": _url(head), "record_type": _value("WARC-Type", head),
        "refers_to": _value("X-Refers-To-Page-Id", head).cast("long"),
        "payload_digest": F.when(whole, F.substring(stated, len("sha256:") + 1, 64)).otherwise(
            F.raise_error(F.lit("a record does not have the body that its header states"))),
        "body_bytes": F.octet_length("_body").cast("long"),
    }
    return parted.withColumns(fields).drop("_text", "_at", "_head", "_body")


def write_warc_files(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records of `read_archive` as WARC files, written by the executors: the blank lines between records are the separator."""
    body = F.expr("substring(record, 1, octet_length(record) - 4)")
    (records.select(body.cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path))
