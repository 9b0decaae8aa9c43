"""WARC archives of pages, and capture histories merged from their sorted indexes."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm.common import BROADCAST_ROWS, attach_groups, query, read, store
from statloom.session import scratch_path

# Payload bytes of an archive, about, and captures merged by one task, about.
ARCHIVE_BYTES = 32 << 20
ARCHIVE_ROWS = 100_000
MERGE_ROWS = 50_000
# Pages carry no time: a capture's time is its id in seconds after this day.
EPOCH = datetime(2020, 1, 1, tzinfo=timezone.utc)
LAST_SECOND = 200_000_000_000
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """SHA-1 in base32, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def capture_time(page_id: int | None) -> str:
    seconds = min(abs(page_id or 0), LAST_SECOND)
    return (EPOCH + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str | None) -> str:
    """Host parts in reverse, then the path: captures of one site are neighbours.

    The scheme, a leading www, letter case of the host and the fragment don't count.
    """
    text = url or ""
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or "").lower(), f":{parts.port}" if parts.port else ""
    except ValueError:
        return text
    if not host:
        return text
    names = host.removeprefix("www.").split(".")
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(names))}{port}){tail}"


def _header(value: str | None) -> str:
    """A header value on one line; what would end the line is percent-coded."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: str, kind: str, sha: str,
           original: int | None) -> str:
    """One record without the blank lines that end it; a revisit has no block of its own."""
    size = len(payload.encode("utf-8", "surrogatepass"))
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>",
        f"WARC-Date: {capture_time(page_id)}", f"WARC-Target-URI: {_header(url)}",
        f"WARC-Payload-Digest: sha1:{sha}", f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Has-URI: {int(url is not None)}", f"X-Payload-Length: {size}", "Content-Type: text/html",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To: {'' if original is None else original}"]
        payload, size = "", 0
    return "\r\n".join([*lines, f"Content-Length: {size}", "", payload])


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(headers, offset, block) of every record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        head = archive.index(b"\r\n\r\n", at)
        lines = archive[at:head].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = head + 4
        end = start + int(fields["Content-Length"])
        if archive[end:end + 4] != END.encode():
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield fields, at, archive[start:end]
        at = end + 4


def loser_tree_merge(runs: list[list]) -> Iterator[tuple[int, int]]:
    """(run, position) of all items of sorted runs in order; equal items by run.

    Inner nodes keep the loser of their match, so each item costs one path of matches from
    its leaf to the root.
    """
    k = len(runs)
    at = [0] * k

    def less(a: int, b: int) -> bool:
        """Does run a come first? A run that is used up comes last."""
        if at[a] >= len(runs[a]):
            return False
        if at[b] >= len(runs[b]):
            return True
        x, y = runs[a][at[a]], runs[b][at[b]]
        return x < y or x == y and a < b

    losers = [-1] * max(1, k)

    def play(node: int) -> int:
        """The winner below a node; leaves are k to 2k - 1."""
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        first, second = (b, a) if less(b, a) else (a, b)
        losers[node] = second
        return first

    if not k:
        return
    winner = play(1) if k > 1 else 0
    while at[winner] < len(runs[winner]):
        yield winner, at[winner]
        at[winner] += 1
        node = (winner + k) // 2
        while node >= 1 and k > 1:
            if less(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for page_id, url, payload, sha, first in zip(
                *(batch[c].tolist() for c in ("id", "url", "payload", "sha", "first")), strict=True):
            page_id, first = (None if pd.isna(x) else int(x) for x in (page_id, first))
            again = first is not None and first != page_id
            code = base64.b32encode(bytes.fromhex(sha)).decode()
            rows.append(record(page_id, url, payload, "revisit" if again else "response", code,
                               first if again else None))
        yield pd.DataFrame({"value": rows})


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per row into gzipped archives of about ``archive_bytes`` payload below ``path``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest
    id is a response, the others revisit it. The archives go through Spark's writer, so
    ``path`` can be any folder that Spark reaches. A null page is an empty payload, a null
    id smaller than every other. Rows of one payload that repeat the largest id are all
    responses. Payloads are never cut.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    named = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                         payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha"))
    size = F.octet_length("payload").cast("long")
    total, rows = named.agg(F.sum(size), F.count("*")).first()
    equal = named.filter(size >= min_bytes).groupBy("sha").agg(
        F.max("id").alias("first"), F.count("*").alias("n"))
    equal = store(equal.filter("n > 1"), "equal-payloads")
    if equal.count() <= BROADCAST_ROWS:
        found = named.join(F.broadcast(equal.drop("n")), "sha", "left")
    else:
        found = attach_groups(named, equal, ["sha"], "n", rows).drop("n")
    archives = max(1, -(-int(total or 0) // archive_bytes), rows // ARCHIVE_ROWS)
    records = found.repartition(archives).mapInPandas(_records, "value string")
    records.write.text(path, lineSep=END, compression="gzip")


INDEX = ("url_key string, captured_at string, page_id long, archive string, offset long, "
         "payload_bytes long, payload_digest string, record_type string, refers_to long")


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each archive its captures, sorted: one run."""
    names = [c.split()[0] for c in INDEX.split(", ")]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            run = []
            for fields, at, block in parse(gzip.decompress(content)):
                url = fields["WARC-Target-URI"] if fields["X-Has-URI"] == "1" else None
                again = fields["WARC-Type"] == "revisit"
                size = int(fields["X-Payload-Length"]) if again else len(block)
                sha = fields["WARC-Payload-Digest"].removeprefix("sha1:") if again else digest(block)
                ids = [int(x) if x else None for x in (fields["X-Page-ID"], fields.get("X-Refers-To", ""))]
                run.append((url_key(url), fields["WARC-Date"], ids[0], path.rsplit("/", 1)[-1], at, size,
                            sha, fields["WARC-Type"], ids[1]))
            run.sort(key=lambda r: (r[0], r[1], r[3], r[4]))
            frame = pd.DataFrame(run, columns=names)
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one range of keys the slices of all runs, merged."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    keys = list(zip(rows["url_key"], rows["captured_at"], rows["archive"], rows["offset"], strict=True))
    places = list(rows.groupby("archive", sort=True).indices.values())
    runs = [[keys[i] for i in place] for place in places]
    for r, run in enumerate(runs):
        # The shuffle keeps a run's order; should it ever not, the slice is sorted again.
        if any(a > b for a, b in zip(run, run[1:], strict=False)):
            places[r] = sorted(places[r], key=lambda i: keys[i])
            runs[r] = sorted(run)
    order = [int(places[r][i]) for r, i in loser_tree_merge(runs)]
    out = rows.iloc[order]
    yield out.assign(part=TaskContext.get().partitionId(), place=np.arange(len(out)))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per capture below ``path``, parsed, with payload size and digest taken anew.

    Each archive is one sorted run. Runs are cut into ranges of (url_key, time) of about
    MERGE_ROWS captures, the slices of a range are merged by a loser tree, and order_no is
    the place in the global order. Revisits have no payload: theirs are the header's values.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    runs = store(archives.select("path", "content").mapInPandas(_index, INDEX), "capture-runs")
    ranges = max(1, -(-runs.count() // MERGE_ROWS))
    ordered = runs.repartitionByRange(ranges, "url_key", "captured_at", "archive", "offset")
    merged = store(ordered.mapInPandas(_merge, INDEX + ", part int, place long"), "captures")
    sizes = merged.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    joined = merged.join(starts, "part")
    return joined.withColumn("order_no", F.col("start") + F.col("place")).drop("part", "place", "start")


SQL = r"""
WITH b AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS h, coalesce(html, '') AS payload FROM pages),
bits AS (
  SELECT *, [CAST(('0x' || substr(h, k * 2 + 1, 2)) AS INTEGER) FOR k IN range(20)] AS bs,
         max(page_id) OVER (PARTITION BY payload) AS first FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_reduce([''] || [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((bs[k * 5 // 8 + 1] * 256 + coalesce(bs[k * 5 // 8 + 2], 0)) >> (11 - k * 5 % 8)) & 31), 1)
    FOR k IN range(32)], lambda x, y: x || y) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits"""


@query("op10_warc", SQL)
def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    path = scratch_path(spark, "warc")
    write_archives(read(spark, sf, "pages"), path)
    captures = read_archives(spark, path)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
