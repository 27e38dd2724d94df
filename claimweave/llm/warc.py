"""WARC archives and their index, merged from sorted runs.

``write_archives`` writes one WARC/1.1 file per task: a response record for the
first capture of each payload, a revisit record for every other one. Records
are text (the payload is UTF-8), so Spark's own writer puts them in any store.
``read_records`` reads the archives back by record length and recomputes digests.
``capture_history`` merges the index: each archive gives a run of captures,
locally sorted by URL key and timestamp; ranges of the key space are dealt to
tasks, and each task merges its slices of all runs with a loser tree, which
yields one globally ordered history.

Defined cases: a null payload is empty; payloads under ``least_bytes`` are
always responses; of equal payloads the smallest page id is the response, null
ids last; rows that repeat an id and payload share their record type; a null or
malformed URL keeps its bytes, control characters and spaces percent-encoded;
captures equal in key and time are ordered by id; an empty table gives empty
archives and an empty index. Only the id, URL and payload columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.ordering import add_offsets
from claimweave.operators import salted_join
from claimweave.sources.sinks import scratch_path, stage

LEAST_BYTES = 0
#: Payload bytes that one archive holds, about.
ARCHIVE_BYTES = 32 << 20
#: Index rows that one task merges, about.
MERGE_ROWS = 100_000
EPOCH = 1_700_000_000
_EOL = "\r\n"
_HEX32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
FIELDS = ("url_key string, ts long, page_id long, url string, record_type string, refers_to long, "
          "payload_bytes long, payload_digest string, archive string, offset long")


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1."""
    digest = F.upper(F.sha1(payload.cast("binary")))
    part = lambda i: F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*[part(i) for i in range(8)]), *_HEX32)


def with_url_key(df: DataFrame, url_col: str = "url", name: str = "url_key") -> DataFrame:
    """Add a URL's sort key: reversed host labels, then the path; scheme, fragment and case dropped."""
    rest = F.regexp_replace(F.lower(F.coalesce(F.col(url_col), F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"#.*$", "")
    host = F.substring_index(rest, "/", 1)
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return df.withColumn(name, F.concat(labels, F.lit(")"), F.substr(rest, F.length(host) + 1)))


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
             time: Column | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Rows (page_id, url, ts, payload, payload_bytes, payload_digest, record_type,
    refers_to). ``time`` is the capture time in seconds; by default ``EPOCH`` plus the id modulo 1e8."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    page = F.col(id_col).cast("long")
    rows = pages.select(page.alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(time if time is not None else F.lit(EPOCH) + F.pmod(page, F.lit(10**8)), F.lit(EPOCH)).cast("long").alias("ts"),
                        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        payload_digest(payload).alias("payload_digest"))
    # Only payloads that occur again need a place in the join.
    again = stage(rows.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1").select(F.col("payload_digest").alias("digest"), "first_id", "n"), "payloads")
    rows = salted_join(rows, again.drop("n"), "payload_digest", "digest", "left", _salts(again))
    revisit = (F.col("digest").isNotNull() & (F.col("payload_bytes") >= least_bytes)
               & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    return rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("first_id"))).drop("digest", "first_id")


def _salts(again: DataFrame) -> dict[str, int]:
    """{digest: salts} of the payloads with so many copies that one task should not get them
    all, were the join to shuffle: at most two for each partition."""
    copies = again.agg(F.sum("n")).first()[0] or 0
    piece = max(2, copies // (2 * int(again.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return {r["digest"]: -(-r["n"] // piece) for r in again.filter(F.col("n") > piece).collect()}


def _record() -> Column:
    """The text of a record, without the two line ends behind it."""
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    url = F.coalesce(F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20"), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL}Content-Length: "),
                    number("payload_bytes"), F.lit(_EOL * 2))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_EOL))
    return F.concat(
        F.lit(f"WARC/1.1{_EOL}"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number("page_id"), F.lit(">"))),
        line("WARC-Date", F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", url), line("X-URL-Key", F.regexp_replace("url_key", "[\\x00-\\x20\\x7f]", "%20")),
        line("X-Capture-Seconds", number("ts")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{_EOL}"),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), number("refers_to"), F.lit(">"))))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{_EOL}"),
        line("Content-Length", F.octet_length(body).cast("string")), F.lit(_EOL), body)


def write_archives(rows: DataFrame, path: str, most_rows: int = 0) -> None:
    """Captures as gzipped WARC files below ``path``: one per task, or several of
    at most ``most_rows`` records."""
    with_url_key(rows).select(_record().alias("value")).write.option("lineSep", _EOL * 2).option(
        "compression", "gzip").option("maxRecordsPerFile", most_rows).text(path)


def _inflated(data: bytes) -> Iterator[bytes]:
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    step = 1 << 20
    while data:
        z, at = zlib.decompressobj(31), 0
        while at < len(data) and not z.eof:
            yield z.decompress(data[at:at + step])
            at += step
        data = z.unused_data + data[at:] if z.eof else b""


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of one archive, by its length."""
    more, held, offset = _inflated(data), bytearray(), 0

    def need(n: int) -> bool:
        while len(held) < n:
            part = next(more, None)
            if part is None:
                return False
            held.extend(part)
        return True

    while need(1):
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not need(len(held) + 1):
                raise ValueError("an archive ends within a record's header")
        lines = held[:end].decode().split(_EOL)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {offset}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(headers["Content-Length"])
        if not need(end + 4 + size + 4):
            raise ValueError("an archive ends within a record")
        yield offset, headers, bytes(held[end + 4:end + 4 + size])
        del held[:end + 8 + size]
        offset += end + 8 + size


def _number(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if value in ("", "null") else int(value)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The index rows of all archives below ``path``; each archive's are sorted
    by URL key, timestamp and id. A payload whose digest is not its header's is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                archive = name.as_py().rsplit("/", 1)[-1]
                out = []
                for offset, head, block in records(content.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(http.rsplit(b": ", 1)[1])
                    if head["WARC-Type"] == "response":
                        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if own != digest or len(payload) != size:
                            raise ValueError(f"{archive}, byte {offset}: the payload is not what its header says")
                    out.append((head["X-URL-Key"], int(head["X-Capture-Seconds"]), _number(head["WARC-Record-ID"]),
                                head["WARC-Target-URI"], head["WARC-Type"], _number(head.get("WARC-Refers-To", "")),
                                size, digest, archive, offset))
                out.sort(key=_order)
                for lo in range(0, len(out), 4096):
                    yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in out[lo:lo + 4096]],
                                                     schema=_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, FIELDS)


_SCHEMA = pa.schema([("url_key", pa.string()), ("ts", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("archive", pa.string()), ("offset", pa.int64())])


def _order(row: tuple) -> tuple:
    return row[0].encode(), row[1], row[2] is None, row[2] or 0, row[8], row[9]


class LoserTree:
    """Merges sorted runs: inner nodes hold the losers of their matches, so the
    next row costs one path from a leaf to the root."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [self._take(i) for i in range(len(runs))]
        self.losers = [-1] * self.k
        for leaf in range(len(runs)):
            self._play(leaf)

    def _take(self, run: int) -> tuple | None:
        row = next(self.runs[run], None)
        return None if row is None else (_order(row), run, row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None if x is None or y is None else x[:2] < y[:2]

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner][2]
            self.heads[winner] = self._take(winner)
            self._play(winner)


def capture_history(index: DataFrame, merge_rows: int = MERGE_ROWS) -> DataFrame:
    """The index in global order of URL key, timestamp and id, with ``position``."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slices.setdefault(row[8], []).append(row)
        out: list[tuple] = []
        for row in LoserTree([iter(slices[name]) for name in sorted(slices)]):
            out.append(row)
            if len(out) == 4096:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)],
                                          schema=_SCHEMA)

    ranges = max(1, -(-index.count() // merge_rows))
    order = ["url_key", "ts", F.col("page_id").asc_nulls_last(), "archive", "offset"]
    dealt = index.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order)
    merged = dealt.mapInArrow(merge, FIELDS).withColumn("_at", F.monotonically_increasing_id())
    return add_offsets(stage(merged, "capture_history"), "position")


def archive_and_index(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                      time: Column | None = None, least_bytes: int = LEAST_BYTES, path: str | None = None,
                      archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives below ``path`` (by default the shared scratch folder),
    read them back and return their merged index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    size = F.octet_length(F.col(payload_col).cast("string"))
    total, n = pages.agg(F.sum(F.coalesce(size, F.lit(0))), F.count(F.lit(1))).first()
    most_rows = max(1, int(archive_bytes * n // total)) if total else 1_000_000
    rows = captures(pages, id_col, url_col, payload_col, time, least_bytes)
    write_archives(rows, path, most_rows)
    return capture_history(stage(read_records(spark, path), "capture_runs"))
