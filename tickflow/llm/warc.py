"""WARC archives of pages, and their index by an external merge.

Pages become WARC records: a ``response`` with its payload, or, for payloads of at
least ``REVISIT_FROM`` bytes that a page with a larger id also has, a ``revisit`` that refers to the
largest such id. Spark's text writer puts them in gzip files; each file is a capture run,
sorted by URL key and time. Pages are written by size, larger ones fewer to a file, so that a file's records have at
most about 64 MB, or are one. A record's block is an HTTP head and the payload, so
a revisit still tells the length, and its header the digest, of the payload it stands for.

``read_archives`` unpacks the files piece by piece, whether they are one gzip member or one for each record, parses them back by
their lengths, a record at a time, and checks digests. It also reads archives of others: records of other types have their block as
payload, ids that are not ours are null, and digests may be written in base 32.
``merged`` deals the runs' entries to ranges of (URL key, time, page) and merges the
stretches that the runs have in a range with a loser tree; ranges follow each other, so the index is globally
ordered, and a URL with very many captures is spread over several ranges. A task
holds index entries of one range, never payloads of more than one file.

Null pages have an empty payload; a null URL has no target and the empty key; rows without
an id are responses and nobody refers to them. Repeated ids are records of their own; equal ids do not
refer to themselves, so all rows with the largest id are responses. A single page is limited by what a file of 2 GB holds.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterable, Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import shared_dir, written

REVISIT_FROM = 1000
#: Pages of up to so many bytes (the last: of any size), and how many of them make a file.
FILES = ((1 << 16, 1024), (1 << 20, 64), (1 << 24, 4), (None, 1))
_PIECE = 1 << 16
#: The format's line end, version, and the profile of revisits.
END, VERSION = "\r\n", "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Host with its labels reversed, then path and query: ``com,example)/path``. Other texts stay as they are."""
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)"
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(url, parts, 1)), r"\.")), ",")
    path = F.regexp_extract(url, parts, 2)
    return F.coalesce(F.when(url.rlike(parts), F.concat(host, F.lit(")"), F.when(path == "", "/").otherwise(path))).otherwise(url), F.lit(""))


def records(pages: DataFrame, epoch: int = 1_704_067_200, over: int = -1, upto: int | None = None) -> DataFrame:
    """(page_id, url, html) -> key, stamp, record (text), of pages with more than ``over`` and up to ``upto`` bytes.

    Pages have no time of their own: it is ``epoch`` plus the id, in seconds.
    """
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    page = page.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    copies = page.filter(F.col("bytes") >= REVISIT_FROM).groupBy("digest").agg(F.max("page_id").alias("original"), F.min("page_id").alias("least"))
    copies = copies.filter("least < original").select("digest", "original")
    page = page.filter(F.col("bytes") > over) if upto is None else page.filter((F.col("bytes") > over) & (F.col("bytes") <= upto))
    page = page.join(copies, "digest", "left")
    revisit = F.coalesce((F.col("bytes") >= REVISIT_FROM) & (F.col("page_id") < F.col("original")), F.lit(False))
    stamp = F.timestamp_seconds(F.lit(epoch) + F.coalesce(F.pmod("page_id", F.lit(1_000_000_000)), F.lit(0)))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes"), F.lit(END + END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    head = F.concat(
        F.lit(VERSION + END),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.date_format("stamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn(F.col("original"))))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
    )
    page = page.withColumn("stamp", stamp).withColumn("key", url_key(F.col("url")))
    return page.select("key", "stamp", "page_id", F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, files: tuple[tuple[int | None, int], ...] = FILES) -> None:
    """One sorted run per file. Records end with two line ends, which is what the writer puts after each."""
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    limits = [limit for limit, _ in files if limit is not None]
    # How many pages are up to each size; a size that no page has is not looked for.
    row = pages.agg(F.count(F.lit(1)), *[F.count_if(size <= limit) for limit in limits]).first()
    upto = [*row[1:], row[0]]
    if not row[0]:
        records(pages).select("record").write.option("compression", "gzip").text(path)
    over = -1
    for k, (limit, per_file) in enumerate(files):
        if upto[k] > (upto[k - 1] if k else 0):
            runs = records(pages, over=over, upto=limit).sortWithinPartitions("key", "stamp", "page_id").select("record")
            runs.write.mode("append").option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)
        over = limit


def unpacked(data: bytes) -> Iterator[bytes]:
    """The content of a gzip file with any number of members, piece by piece."""
    member, held, begun = zlib.decompressobj(31), memoryview(data), False
    for at in range(0, len(held), _PIECE):
        piece = bytes(held[at : at + _PIECE])
        while piece:
            out, begun = member.decompress(piece, 16 * _PIECE), True
            if out:
                yield out
            piece = member.unconsumed_tail
            if member.eof:
                piece, member, begun = member.unused_data, zlib.decompressobj(31), False
    if begun:
        raise ValueError("the archive ends inside a member")


def parse(pieces: Iterable[bytes]) -> Iterator[tuple[int, dict[str, str], bytes, int]]:
    """(offset, headers in lower case, payload, length of the payload as the HTTP head tells it) of the records of an archive.

    Holds one record at a time. Blocks that are no HTTP response are payloads as they are.
    """
    pieces, held, at, end = iter(pieces), bytearray(), 0, END.encode()

    def until(n: int) -> bool:
        """Have at least ``n`` bytes at hand, if there are so many."""
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while until(1):
        stop = held.find(end + end)
        while stop < 0:
            before = len(held)
            if not until(before + 1):
                raise ValueError(f"no record at {at}")
            stop = held.find(end + end, max(0, before - 3))
        first, *lines = held[:stop].decode().split(END)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = {name.strip().lower(): value.strip() for name, value in (line.split(":", 1) for line in lines)}
        begin = stop + 4
        after = begin + int(headers["content-length"])
        if not until(after):
            raise ValueError(f"the record at {at} ends early")
        block = bytes(held[begin:after])
        length = len(block)
        if headers.get("content-type", "").replace(" ", "") == "application/http;msgtype=response":
            http = block.index(end + end)
            told = [h.split(b":")[1] for h in block[:http].split(end) if h.lower().startswith(b"content-length:")]
            block = block[http + 4 :]
            length = int(told[0]) if told else len(block)
        yield at, headers, block, length
        until(after + 4)
        del held[: after + 4]
        at += after + 4


def _hex_digest(value: str | None) -> str | None:
    """A SHA-1 digest as lower-case hex, from that or from base 32; other digests are not known here."""
    name, _, digest = (value or "").partition(":")
    if name.lower() != "sha1":
        return None
    return base64.b32decode(digest.upper()).hex() if len(digest) == 32 else digest.lower()


_ENTRY = "key string, stamp string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, run string, place long, offset long"
_NAMES = [c.split()[0] for c in _ENTRY.split(", ")]


def _page_of(urn: str | None) -> int | None:
    """The page of a record id of ours, ``<urn:page:7>``."""
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.removeprefix("-").isdecimal() else None


def _entries(batches):
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows = []
            for place, (offset, head, payload, length) in enumerate(parse(unpacked(content.as_buffer()))):
                kind, digest = head.get("warc-type"), _hex_digest(head.get("warc-payload-digest"))
                if kind != "revisit":
                    own = sha1(payload).hexdigest()
                    if digest not in (None, own) and kind == "response" or len(payload) != length:
                        raise ValueError(f"damaged record at {offset} of {path}")
                    digest = digest or own
                url = head.get("warc-target-uri")
                rows.append((None, head.get("warc-date"), _page_of(head.get("warc-record-id")), url, kind, length, digest, _page_of(head.get("warc-refers-to")), path, place, offset))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], _NAMES)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of the archives in a folder, in the order of their runs."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(_entries, _ENTRY).withColumn("key", url_key(F.col("url")))


class LoserTree:
    """Merges k sorted lists of keys: yields (list, position) in order; ties go to the earlier list."""

    def __init__(self, lists: list[list]):
        self.lists, self.k = lists, len(lists)
        self.at = [0] * self.k
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k else -1

    def _beats(self, a: int, b: int) -> bool:
        x = self.lists[a][self.at[a]] if self.at[a] < len(self.lists[a]) else None
        y = self.lists[b][self.at[b]] if self.at[b] < len(self.lists[b]) else None
        return y is None and (x is not None or a < b) or x is not None and y is not None and (x, a) < (y, b)

    def _play(self, node: int) -> int:
        """Plays out the matches below a node; leaves are k .. 2k - 1."""
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return won

    def __iter__(self):
        for _ in range(sum(map(len, self.lists))):
            won = self.winner
            yield won, self.at[won]
            self.at[won] += 1
            node = (won + self.k) // 2
            while node:
                if self._beats(self.losers[node], won):
                    won, self.losers[node] = self.losers[node], won
                node //= 2
            self.winner = won


def _merge(batches):
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    runs = table.column("run").to_pylist()
    keys = list(zip(table.column("key").to_pylist(), table.column("stamp").to_pylist(), (i if i is not None else -(1 << 63) for i in table.column("page_id").to_pylist())))
    starts = [i for i in range(len(runs)) if i == 0 or runs[i] != runs[i - 1]]
    order = [starts[run] + at for run, at in LoserTree([keys[a:b] for a, b in zip(starts, [*starts[1:], len(keys)])])]
    yield from table.take(pa.array(order, pa.int64())).combine_chunks().to_batches()


def merged(entries: DataFrame, rows: int = 100_000) -> DataFrame:
    """The entries of all runs in global order of (key, stamp, page_id): partition after partition."""
    entries = written(entries, "runs")
    parts = max(1, -(-entries.count() // rows))
    ranges = entries.repartitionByRange(parts, "key", "stamp", F.col("page_id").asc_nulls_first())
    return ranges.sortWithinPartitions("run", "place").mapInArrow(_merge, entries.schema)


def archived(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back and merges their index."""
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return merged(read_archives(pages.sparkSession, path))
