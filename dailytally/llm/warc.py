"""WARC archives and their merged capture index.

Archives are written by Spark's own text writer, one record per line with the
record's closing CRLF CRLF as line separator, gzipped; and read back by its text
reader, split at the opening of this run's records (version line and the start of
a record id that holds a random run id, so no payload can contain it). Any file
system that Spark reaches will do, and a file is streamed, never held whole.

Of records with equal payloads the one with the largest page_id is a response, the
others are revisits without a payload that refer to it. Reading checks every
record's length and every response's digest.

The index: each archive is a capture run, sorted by URL key, time and page in its
task and written; the runs are dealt by ranges of that key and each range merged
by a loser tree, which gives globally ordered histories. A URL with very many
captures spans several ranges, as time and page belong to the key.

Null html: an empty payload. Null url: an empty target and key. Null page_id: the
earliest time; it is a response only if no equal payload has an id. Repeated rows: each
has its record, and a record id of its own (page_id, payload digest, number of the copy); of those with the largest page_id and equal payloads
the one of the least url is the response (of equal rows any one), the others revisit that id. Any
page_id: dates come from its remainder by 2^31. Very long texts: like others. Extra columns are never
read. Empty table: no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailytally.llm.common import stored
from dailytally.llm.urlfilter import host_of, path_of
from dailytally.session import work_path

CRLF = "\r\n"
END = CRLF + CRLF
#: Payloads of at least so many bytes are revisited when equal.
LEAST_BYTES = 0
#: Captures are dated so many seconds after this time as their page_id says, modulo SPAN.
EPOCH = 1_700_000_000
SPAN = 1 << 31
HTTP = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + END
#: The digits of base 32 as conv() and as RFC 4648 write them.
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Index rows in a range, about.
RANGE_ROWS = 100_000
INDEX = "urlkey string, captured long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: eight groups of five hex digits, four base-32 digits each."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), CONV32, RFC32)


def url_key(url: Column) -> Column:
    """Host labels from the last on, then the path, as in com,example)/page."""
    labels = F.array_join(F.reverse(F.split(host_of(url), r"\.")), ",")
    return F.when(host_of(url) == "", F.lit("")).otherwise(F.concat(labels, F.lit(")"), path_of(url)))


def opening(run: str) -> str:
    return f"WARC/1.1{CRLF}WARC-Record-ID: <urn:run:{run}:"


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, bytes, digest, response_id, copy (tells rows of one page_id and payload apart), is_response."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    base = base.withColumns({"bytes": F.octet_length("payload").cast("long"), "equal": F.unhex(F.sha2("payload", 256)), "digest": base32_sha1(F.col("payload"))})
    held = stored(base.groupBy("equal", "page_id").agg(F.count("*").alias("rows"), F.max("bytes").alias("size")), "warc-payloads")
    latest = held.filter(F.col("size") >= LEAST_BYTES).groupBy("equal").agg(F.max("page_id").alias("response_id"))
    again = held.filter("rows > 1 AND page_id IS NOT NULL").select("equal", "page_id")
    # Rows without an id need a record id of their own, too.
    none = F.when(F.col("page_id").isNull(), F.monotonically_increasing_id()).otherwise(0)
    if again.take(1):
        single = base.join(again, ["equal", "page_id"], "left_anti").withColumn("copy", none)
        w = Window.partitionBy("equal", "page_id").orderBy("url")
        several = base.join(again, ["equal", "page_id"], "left_semi").withColumn("copy", F.row_number().over(w).cast("long") - 1)
        base = single.unionByName(several)
    else:
        base = base.withColumn("copy", none)
    out = base.join(latest, "equal", "left").drop("equal")
    first = (F.col("page_id") == F.col("response_id")) & (F.col("copy") == 0)
    return out.withColumn("is_response", F.when(F.col("response_id").isNull(), True).otherwise(F.coalesce(first, F.lit(False))))


def record_text(run: str) -> Column:
    """A record without its closing CRLF CRLF."""
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "_")
    block = F.concat(F.lit(HTTP), F.when(F.col("is_response"), F.col("payload")).otherwise(F.lit("")))
    date = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(SPAN))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    refers = F.when(~F.col("is_response"), F.concat(
        F.lit(f"WARC-Refers-To: <urn:run:{run}:"), F.col("response_id").cast("string"), F.lit("-"), F.col("digest"), F.lit(">" + CRLF))).otherwise(F.lit(""))
    return F.concat(
        F.lit(opening(run)), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("-"), F.col("digest"),
        F.when(F.col("copy") > 0, F.concat(F.lit("-copy-"), F.col("copy").cast("string"))).otherwise(F.lit("")), F.lit(">" + CRLF),
        F.lit("WARC-Type: "), F.when(F.col("is_response"), F.lit("response")).otherwise(F.lit("revisit")), F.lit(CRLF),
        F.lit("WARC-Date: "), date, F.lit(CRLF + "WARC-Target-URI: "), uri,
        F.lit(CRLF + "WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF + "X-Payload-Length: "), F.col("bytes").cast("string"),
        F.lit(CRLF), refers, F.lit("Content-Type: application/http;msgtype=response" + CRLF + "Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(END), block)


def write_archives(pages: DataFrame, path: str) -> str:
    """Writes gzipped WARC files below the path; returns the run id that reading needs."""
    run = uuid.uuid4().hex
    records(pages).select(record_text(run).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)
    return run


def read_archives(spark, path: str, run: str) -> DataFrame:  # noqa: ANN001
    """The records, checked: the index columns, url and payload (null for revisits)."""
    lines = spark.read.option("lineSep", opening(run)).text(path).filter(F.col("value") != "")
    head = F.substring_index("value", END, 1)
    split = lines.select(head.alias("head"), F.expr(f"substring(value, length(substring_index(value, '{END}', 1)) + 5)").alias("block"))

    def field(name: str, pattern: str = "([^\r]*)") -> Column:
        return F.regexp_extract("head", f"\r\n{name}: {pattern}", 1)

    parsed = split.select(
        F.expr("try_cast(regexp_extract(head, '^(-?[0-9]*)-', 1) AS long)").alias("page_id"),
        field("WARC-Type").alias("record_type"), field("WARC-Date").alias("date"), field("WARC-Target-URI").alias("url"),
        field("WARC-Payload-Digest", "sha1:([^\r]*)").alias("payload_digest"), field("X-Payload-Length").cast("long").alias("payload_bytes"),
        F.expr("try_cast(regexp_extract(head, '\r\nWARC-Refers-To: <[^>]*:(-?[0-9]+)-', 1) AS long)").alias("refers_to"),
        field("Content-Length").cast("long").alias("length"),
        F.expr("substring(block, 1, length(block) - 4)").alias("block"),
    )
    payload = F.when(F.col("record_type") == "response", F.expr(f"substring(block, {len(HTTP) + 1})"))
    whole = (F.octet_length("block") == F.col("length")) & F.coalesce(base32_sha1(payload) == F.col("payload_digest"), F.lit(True))
    checked = F.when(whole, F.col("page_id")).otherwise(F.raise_error(F.concat(F.lit("damaged WARC record of page "), F.col("page_id").cast("string"))).cast("long"))
    return parsed.select(
        url_key(F.col("url")).alias("urlkey"), F.unix_timestamp(F.to_timestamp("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("captured"),
        checked.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url", payload.alias("payload"))


class LoserTree:
    """Merges k sorted runs: each inner node holds the run that lost there, so the
    next row takes one comparison per level."""

    def __init__(self, runs: list[list]) -> None:
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * self.k
        self.best = self._build(1) if self.k > 1 else 0

    def _head(self, run: int):  # noqa: ANN202
        return self.runs[run][self.at[run]] if self.at[run] < len(self.runs[run]) else None

    def _wins(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        return x is not None and (y is None or (x, a) <= (y, b))

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        won, lost = (a, b) if self._wins(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator:
        while self.k and (row := self._head(self.best)) is not None:
            yield row
            run = self.best
            self.at[run] += 1
            node = (run + self.k) // 2
            while node:
                if self._wins(self.losers[node], run):
                    run, self.losers[node] = self.losers[node], run
                node //= 2
            self.best = run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the key: its part of every run, merged."""
    got = list(batches)
    if not got:
        return
    rows = pa.Table.from_batches(got).combine_chunks()
    ids = rows.column("page_id").to_pylist()
    keys = list(zip(rows.column("urlkey").to_pylist(), rows.column("captured").to_pylist(),
                    [i is not None for i in ids], [i or 0 for i in ids], range(len(ids)), strict=True))
    own: dict[str, list] = {}
    for run, key in zip(rows.column("run").to_pylist(), keys, strict=True):
        own.setdefault(run, []).append(key)
    for run in own.values():
        run.sort()  # in order already, unless a fetch was split
    order = [key[4] for key in LoserTree([own[k] for k in sorted(own)])]
    merged = rows.drop_columns(["run"]).take(order).append_column("place", pa.array(range(len(order)), pa.int64()))
    yield from merged.combine_chunks().to_batches()


def merged_index(index: DataFrame) -> DataFrame:
    """The index rows with ``position``, their place in global order (from 0)."""
    runs = stored(
        index.withColumn("run", F.spark_partition_id().cast("string")).sortWithinPartitions("urlkey", "captured", "page_id"), "runs")
    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(ranges, "urlkey", "captured", "page_id")
    merged = dealt.mapInArrow(_merge, dealt.drop("run").schema.add("place", "long"))
    merged = stored(merged.withColumn("range", F.spark_partition_id()), "merged")
    sizes = merged.groupBy("range").agg(F.count("*").alias("rows"))  # a row for each RANGE_ROWS rows
    before = F.coalesce(F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("range").alias("of"), before.cast("long").alias("start"))
    return merged.join(starts, F.col("range") == F.col("of")).withColumn("position", F.col("start") + F.col("place")).drop("range", "place", "of", "start")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes, reads back, indexes: one row per page with its position in the merged index."""
    path = work_path(pages.sparkSession, "llm", "warc")
    run = write_archives(pages, path)
    read = read_archives(pages.sparkSession, path, run)
    return merged_index(read.select("urlkey", "captured", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
