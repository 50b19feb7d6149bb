"""A content-addressed WARC archive.

Payloads are stored once, under their SHA-256, as gzip members in payload files. The exact header
of every record is kept in separate header files and names the payload by its digest. Records come
back by joining headers with payloads; the digest of every payload is verified when it is stored
and again when it is read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmalign.llm.common import (cut_lineage, cut_rows, map_arrow, open_file, shared_folder,
                                  spread, table, task_file)

DATE = "1970-01-01T00:00:00Z"
FILES = "path string, n_entries bigint"
#: Fixed value: profile of a revisit with an identical payload, from the WARC 1.1 specification.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Archive:
    """Lists of the payload and header files; the lists are kept as tables."""
    payloads: DataFrame
    headers: DataFrame


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archive(pages: DataFrame, folder: str, date: str = DATE, dedup_from: int = 0) -> Archive:
    """Store page_id, url and html of every page.

    Of records with equal payloads of ``dedup_from`` bytes or more, the one with the largest
    page_id is the response and the others revisit it; records with that same id are all
    responses. Records without a page_id are revisits unless no equal payload has an id. A missing
    html is an empty payload, a missing url has no header. Other columns are ignored.
    """
    source = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                          F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unique = map_arrow(source.select("payload"), _compress, "digest string, member binary")
    payloads = cut_lineage(map_arrow(
        unique.repartition(parts, "digest").sortWithinPartitions("digest"),
        lambda batches: _write_payloads(batches, f"{folder}/payloads"), FILES), "warc-payloads")

    facts = cut_lineage(source.select(
        "page_id", "url", F.sha2("payload", 256).alias("digest"),
        _base32(F.sha1("payload")).alias("sha1"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes")), "warc-facts")
    leaders = facts.groupBy("digest").agg(F.max("page_id").alias("leader"),
                                          F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    known = facts.join(leaders, "digest", "left").withColumn(
        "refers_to", F.when((F.col("payload_bytes") >= dedup_from)
                            & ~F.col("page_id").eqNullSafe(F.col("leader")), F.col("leader")))
    headers = cut_lineage(map_arrow(
        known.select(_header(date).alias("header")),
        lambda batches: _write_headers(batches, f"{folder}/headers"), FILES), "warc-headers")
    return Archive(payloads, headers)


def read_headers(archive: Archive) -> DataFrame:
    """The records, from their headers alone."""
    def run(batches):
        for path in _paths(batches):
            rows = []
            with open_file(path, "r") as file:
                for block in _members(file):
                    rows += [_parse(h) for h in block.decode().split("\r\n\r\n")[:-1]]
            yield [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 7

    return map_arrow(spread(archive.headers, archive.headers.count()), run,
                     "page_id bigint, url string, record_type string, refers_to bigint, "
                     "digest string, sha1 string, header string")


def read_payloads(archive: Archive, with_bytes: bool = False) -> DataFrame:
    """Every payload once, with its digests as found in the bytes that were read."""
    def run(batches):
        for path in _paths(batches):
            with open_file(path, "r") as file:
                for digest, member in _entries(file):
                    payload = gzip.decompress(member)
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload {digest} in {path} is damaged")
                    yield ([[digest], [len(payload)], [sha1_base32(payload)]]
                           + [[payload]] * with_bytes)

    return map_arrow(spread(archive.payloads, archive.payloads.count()), _gathered(run),
                     "digest string, payload_bytes bigint, found_sha1 string"
                     + ", payload binary" * with_bytes)


def read_records(archive: Archive, with_bytes: bool = False) -> DataFrame:
    """The archived records, joined with their payloads; a digest that differs is an error."""
    # Spark judges both sides by the short lists of files they are read from, so it would broadcast
    # payloads of any size; the hint makes it shuffle both.
    payloads = read_payloads(archive, with_bytes).hint("merge")
    found = read_headers(archive).join(payloads, "digest", "left")
    same = F.col("sha1").eqNullSafe(F.col("found_sha1"))
    return found.withColumn("sha1", F.when(same, F.col("sha1")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its record: "), "digest")).cast(
            "string")))


def _compress(batches):
    """Each payload once for each task, compressed and verified."""
    seen = set()
    for batch in cut_rows(batches):
        out = []
        for payload in batch.column(0).to_pylist():
            digest = hashlib.sha256(payload).digest()
            if digest not in seen:
                seen.add(digest)
                out.append((digest.hex(), gzip.compress(payload, 3, mtime=0)))
        if out:
            yield [list(c) for c in zip(*out, strict=True)]


def _write_payloads(batches, folder: str):
    """Rows come sorted by digest, so a repeated one follows its first."""
    path, last, n, file = task_file(folder, ".payloads"), None, 0, None
    for batch in batches:
        for digest, member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if digest == last:
                continue
            if hashlib.sha256(gzip.decompress(member)).hexdigest() != digest:
                raise ValueError(f"payload {digest} was damaged on its way")
            file = file or open_file(path, "w")
            file.write(f"{digest} {len(member)}\n".encode() + member)
            last, n = digest, n + 1
    if file:
        file.close()
        yield [[path], [n]]


def _write_headers(batches, folder: str):
    path, n, file = task_file(folder, ".headers"), 0, None
    for batch in batches:
        if batch.num_rows:
            file = file or open_file(path, "w")
            block = gzip.compress("".join(batch.column(0).to_pylist()).encode(), mtime=0)
            file.write(b"headers %d\n" % len(block) + block)
            n += batch.num_rows
    if file:
        file.close()
        yield [[path], [n]]


def _paths(batches):
    for batch in batches:
        yield from batch.column(0).to_pylist()


def _entries(file):
    """(name, bytes) of the entries of a file, each preceded by a line with name and length."""
    rest = b""
    while True:
        while b"\n" not in rest:
            more = file.read(1 << 20)
            if not more:
                return
            rest += more
        line, _, rest = rest.partition(b"\n")
        name, length = line.decode().split(" ")
        need = int(length) - len(rest)
        if need > 0:
            rest += file.read(need)
        yield name, rest[:int(length)]
        rest = rest[int(length):]


def _members(file):
    for _, member in _entries(file):
        yield zlib.decompress(member, 31)


def _gathered(run, rows: int = 256, size: int = 8 << 20):
    """Join single rows to batches."""
    def gather(batches):
        held, held_bytes = [], 0
        for row in run(batches):
            held.append(row)
            held_bytes += len(row[-1][0])
            if len(held) >= rows or held_bytes > size:
                yield [[r[k][0] for r in held] for k in range(len(row))]
                held, held_bytes = [], 0
        if held:
            yield [[r[k][0] for r in held] for k in range(len(held[0]))]
    return gather


def _base32(hex_digest):
    """Upper-case base 32 of 40 hexadecimal digits: five of them make four letters."""
    return F.concat(*[F.translate(
        F.lpad(F.conv(F.substring(hex_digest, 5 * k + 1, 5), 16, 32), 4, "0"),
        "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for k in range(8)])


def _header(date: str):
    """Record header with the line that ends it; line breaks in a url are percent-encoded."""
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"),
                                                               F.lit("none")), F.lit(">"))
    is_revisit = F.col("refers_to").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), ident("page_id")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.concat(F.lit("WARC-Block-SHA256: "), F.col("digest")),
        F.when(is_revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), ident("refers_to"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(is_revisit, 0).otherwise(
            F.col("payload_bytes")).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


_ID = re.compile(r"<urn:page:(-?\d+)>")


def _parse(header: str) -> tuple:
    fields = dict(line.split(": ", 1) for line in header.split("\r\n")[1:])
    ident = lambda name: int(m[1]) if (m := _ID.match(fields.get(name, ""))) else None
    return (ident("WARC-Record-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"],
            ident("WARC-Refers-To"), fields["WARC-Block-SHA256"],
            fields["WARC-Payload-Digest"].removeprefix("sha1:"), header)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = write_archive(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    return read_records(archive).select("page_id", "payload_bytes",
                                        F.col("sha1").alias("payload_digest"), "record_type",
                                        "refers_to")
