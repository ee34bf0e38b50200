"""Web archives: writing WARC files, reading them back, and their merged index.

Writing. Payloads are told apart by SHA-256 and length. Of equal payloads of at least
``least_bytes`` the record of the smallest page_id is a response and the others revisit it,
without their payload; smaller payloads are all responses. Texts are joined with that
decision once and written by Spark's text sink, whose line end is the last byte of a
record's closing CRLF CRLF, so that the files are plain WARC, gzip compressed.

Reading. An archive is one capture run. A task parses its records by their lengths, checks
payloads against their digests, and sorts the run's index by (url key, time, page_id).

Merging. The runs are cut by ranges of that same key, so that a url with very many
captures spans several tasks, and each task merges its parts of all runs with a tree of
losers. Partition by partition the result is globally ordered; ``capture`` numbers the
captures of one url key from 1.

Defined results: a null html has the empty payload; a null url has no target and the key
''. Line ends in urls are percent-encoded. Rows of one page_id and payload are each a
record of the same type; a null page_id is a response only if no other page has its
payload. Every input row gives one record. Columns other than page_id, url and html are not
read.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wayframe.sources.scratch import scratch_path, settle

LEAST_BYTES = 100
FIRST_CAPTURE = 1_577_836_800  # seconds; a page without a time of its own is captured page_id seconds later
RECORDS_PER_FILE = 4000
ROWS_PER_MERGE = 200_000
_CRLF = "\r\n"


def _payload() -> Column:
    return F.coalesce(F.col("html").cast("string"), F.lit(""))


def utc_text(seconds: Column) -> Column:
    """Seconds since 1970 as a UTC time, whatever the session's time zone."""
    days, rest = F.floor(seconds / 86400), F.pmod(seconds, F.lit(86400))
    clock = [F.lpad(F.floor(part).cast("string"), 2, "0") for part in (rest / 3600, rest % 3600 / 60, rest % 60)]
    return F.concat(F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")).cast("string"), F.lit("T"), F.concat_ws(":", *clock), F.lit("Z"))


def record_types(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, bytes, refers_to) once per page_id and payload."""
    hashed = pages.select("page_id", F.sha2(_payload(), 256).alias("digest"), F.octet_length(_payload()).cast("long").alias("bytes"))
    hashed = settle(hashed.distinct(), "digests")
    # Written, so that a payload that very many pages have is split by the skew join.
    firsts = settle(hashed.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first")), "firsts")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return hashed.join(firsts, "digest", "left").select("page_id", "digest", "bytes", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> str:
    """Write one record per row of pages (page_id, url, html[, captured in seconds])."""
    captured = F.col("captured") if "captured" in pages.columns else F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0))
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), _payload().alias("html"), F.sha2(_payload(), 256).alias("digest"),
        captured.cast("long").alias("captured"))
    types = record_types(pages, least_bytes).alias("t")
    rows = rows.alias("p").join(
        types, F.col("p.page_id").eqNullSafe(F.col("t.page_id")) & (F.col("p.digest") == F.col("t.digest"))
    ).select("p.*", "t.bytes", "t.refers_to")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), "bytes", F.lit(2 * _CRLF))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit(f"WARC/1.1{_CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{_CRLF}WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f">{_CRLF}WARC-Date: "), utc_text(F.col("captured")),
        F.coalesce(F.concat(F.lit(f"{_CRLF}WARC-Target-URI: "), target), F.lit("")),
        F.lit(f"{_CRLF}WARC-Payload-Digest: sha256:"), "digest",
        F.coalesce(F.concat(
            F.lit(f"{_CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{_CRLF}WARC-Refers-To: <urn:page:"),
            F.col("refers_to").cast("string"), F.lit(">")), F.lit("")),
        F.lit(f"{_CRLF}Content-Type: application/http; msgtype=response{_CRLF}Content-Length: "),
        (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string"), F.lit(2 * _CRLF))
    record = F.concat(header, http, F.when(revisit, "").otherwise(F.col("html")), F.lit("\r\n\r"))
    rows.select(record.alias("value")).write.option("lineSep", "\n").option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    return path


def url_key(url: str | None) -> str:
    """The host's labels from the top level down, then the rest of the url, lower-cased."""
    if not url or "://" not in url:
        return (url or "").lower()
    rest = url.split("://", 1)[1].lower()
    end = min((at for at in (rest.find(c) for c in "/?#") if at >= 0), default=len(rest))
    return ",".join(reversed(rest[:end].split("."))) + ")" + rest[end:]


def records(content: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """The records of one gzip compressed archive: fields, http fields, payload."""
    import gzip

    def fields(lines) -> dict[str, str]:
        found = {}
        while (line := lines.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            found[name] = value
        return found

    with gzip.GzipFile(fileobj=io.BytesIO(content)) as archive:
        while line := archive.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"no WARC record begins with {line[:40]!r}")
            head = fields(archive)
            block = io.BytesIO(archive.read(int(head["Content-Length"])))
            if archive.read(4) != b"\r\n\r\n":
                raise ValueError("a WARC record does not end where its length says")
            block.readline()
            yield head, fields(block), block.read()


_INDEX = "run long, url_key string, captured string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _index_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted index of each archive."""
    for batch in batches:
        for at in range(batch.num_rows):
            run = zlib.crc32(batch.column("path")[at].as_py().rpartition("/")[2].encode())
            rows = []
            for head, http, payload in records(batch.column("content")[at].as_py()):
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                if head["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                size = len(payload) if head["WARC-Type"] == "response" else int(http["Content-Length"])
                rows.append((url_key(head.get("WARC-Target-URI")), head["WARC-Date"], _page(head["WARC-Record-ID"]),
                             head["WARC-Type"], size, digest, _page(head.get("WARC-Refers-To"))))
            rows.sort(key=_order)
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([run] * len(rows), pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[part.split()[0] for part in _INDEX.split(", ")])


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, runs: list[list]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        k = len(self.runs)
        self.losers = [0] * max(1, k)
        winner = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            left, right = winner[2 * node], winner[2 * node + 1]
            first = self._before(left, right)
            winner[node], self.losers[node] = (left, right) if first else (right, left)
        self.losers[0] = winner[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def __iter__(self) -> Iterator:
        while self.runs and (head := self.heads[self.losers[0]]) is not None:
            yield head
            run = self.losers[0]
            self.heads[run] = next(self.runs[run], None)
            node = (run + len(self.runs)) // 2
            while node:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.losers[0] = run


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of all runs, which come one after the other, merged; bounded by ROWS_PER_MERGE or so."""
    from pyspark import TaskContext

    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    keys = list(zip(*(table.column(c).to_pylist() for c in ("url_key", "captured", "page_id"))))
    runs: list[list] = []
    last = None
    for at, run in enumerate(table.column("run").to_pylist()):
        if run != last:
            runs.append([])
            last = run
        runs[-1].append((_order(keys[at]), at))
    order = [at for _, at in LoserTree(runs)]
    place, key = [], None
    for at in order:
        place.append(place[-1] + 1 if keys[at][0] == key else 1)
        key = keys[at][0]
    out = table.take(pa.array(order, pa.int64()))
    out = out.append_column("part", pa.array([TaskContext.get().partitionId()] * len(order), pa.int32()))
    yield from out.append_column("place", pa.array(place, pa.int64())).to_batches()


def merged_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of all archives below path, globally ordered by (url_key, captured, page_id)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    runs = settle(files.mapInArrow(_index_runs, _INDEX), "runs")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // ROWS_PER_MERGE))
    key = ["url_key", "captured", "page_id"]
    merged = settle(
        runs.repartitionByRange(ranges, *key).sortWithinPartitions("run", *key)
        .mapInArrow(_merge_runs, _INDEX + ", part int, place long"), "merged")
    # A key that spans ranges goes on counting where the range before it ended.
    spans = merged.groupBy("url_key", "part").agg(F.count("*").alias("n"))
    before = spans.withColumn("before", F.sum("n").over(
        Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    before = settle(before.where("before > 0").select("url_key", "part", "before"), "spans")
    return merged.join(before, ["url_key", "part"], "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured",
        (F.col("place") + F.coalesce("before", F.lit(0))).alias("capture"))


def archive(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write pages as archives and return their merged index."""
    spark = pages.sparkSession
    return merged_index(spark, write_archives(pages, scratch_path(spark, "archives"), least_bytes))
