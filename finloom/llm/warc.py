"""WARC archives written by Spark, and read back in splits by boundary-chain verification."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.operators.lookup import lookup_join
from finloom.session import materialize

#: Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP_END = b"\r\n\r\n"

#: Identity of a page's record.
RECORD_ID = "urn:x-page:"

#: Rows of (page, digest, page referred to) that are sent to every task; more are joined by shuffle.
MOST_SENT = 100_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column, 32 letters."""
    digits = F.sha1(payload)
    fives = [F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int") for k in range(8)]
    letters = [F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for v in fives for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def write_pages(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row, in uncompressed WARC files under path.

    The payload is the column in UTF-8, a null one empty. Of rows with equal payloads of at least
    least_bytes bytes that with the largest id is a response, the others are revisits that refer to it
    and carry no payload. Rows that repeat the largest id are responses too, as are all rows of a
    payload without any id. Payloads are compared by length and SHA-1. Control characters and blanks of a url are
    percent-encoded; a null url gives no line. Other columns are ignored; an empty table writes
    no record.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload")).withColumn("digest", base32_sha1(F.col("payload")))
    light = materialize(rows.where(F.col("size") >= least_bytes).select("id", "size", "digest"), "digests")
    shared = light.groupBy("digest", "size").agg(F.max("id").alias("refers"), F.count("*").alias("n")).where("n > 1 AND refers IS NOT NULL")
    again = lookup_join(light, shared, ["digest", "size"]).where("NOT (id <=> refers)").select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("size").alias("_size"), "refers").distinct()
    again = materialize(again, "revisits")
    few = again.count() <= MOST_SENT
    named = rows.join(F.broadcast(again) if few else again, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size")), "left")
    first = F.col("refers").isNull()
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"), F.when(first, F.col("payload").cast("string")).otherwise(""))
    url = F.col("url")
    for char, code in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")):
        url = F.replace(url, F.lit(char), F.lit(code))
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(first, "response").otherwise("revisit"),
        F.lit(f"\r\nWARC-Record-ID: <{RECORD_ID}"),
        F.coalesce(F.col("id").cast("string"), F.lit("none")),
        F.lit(f">\r\nWARC-Date: {date}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.coalesce(F.concat(F.lit(f"\r\nWARC-Refers-To: <{RECORD_ID}"), F.col("refers").cast("string"), F.lit(">")), F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
    )
    named.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two magics, in file order, with its file and split."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary").alias("value"))


_HEADER = re.compile(rb"^([A-Za-z-]+):[ \t]*([^\r\n]*)\r?$", re.M)


def _parse(value: bytes) -> tuple[dict[bytes, bytes], int, int] | None:
    """Header fields, where the block begins, and its length; None for what is no record."""
    end = value.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.lower(): v.strip() for k, v in _HEADER.findall(value[:end])}
    size = fields.get(b"content-length", b"")
    return (fields, end + 4, int(size)) if size.isdigit() else None


def _page(field: bytes | None) -> int | None:
    m = re.fullmatch(rb"<?" + RECORD_ID.encode() + rb"(-?\d+)>?", field or b"")
    return int(m[1]) if m else None


def _payload(block: bytes) -> bytes:
    at = block.find(HTTP_END)
    return block[at + 4 :] if at >= 0 else block


CANDIDATE = "file string, split long, at long, next long, block_at long, type string, page_id long, refers_to long, uri string, digest string, whole boolean, payload_bytes long, payload_digest string"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every candidate record of a split, with offsets from the split's first segment, and the
    offset at which its successor must begin."""
    here, at = None, 0
    names = [x.split()[0] for x in CANDIDATE.split(", ")]
    for batch in batches:
        out = []
        for file, split, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, split) != here:
                here, at = (file, split), 0
            got = _parse(value) if at or split else None  # a file's first segment is before any magic
            if got:
                fields, begin, size = got
                whole = begin + size <= len(value)
                payload = _payload(value[begin : begin + size]) if whole else b""
                out.append(
                    (file, split, at, at + begin + size + len(RECORD_END) + len(MAGIC), at + begin, fields.get(b"warc-type", b"").decode("utf-8", "replace"), _page(fields.get(b"warc-record-id")), _page(fields.get(b"warc-refers-to")), fields[b"warc-target-uri"].decode("utf-8", "replace") if b"warc-target-uri" in fields else None,
                     fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("utf-8", "replace"), whole, len(payload) if whole else None, base64.b32encode(hashlib.sha1(payload).digest()).decode() if whole else None)
                )
            at += len(value) + len(MAGIC)
        if out:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=names), schema=_CANDIDATE_SCHEMA, preserve_index=False)


_CANDIDATE_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[t]) for n, t in (x.split() for x in CANDIDATE.split(", "))])


def _chains(batch: pd.DataFrame) -> pd.DataFrame:
    """Of one split: where the chain from each candidate leaves the split."""
    batch = batch.sort_values("at", ascending=False)
    leaves: dict[int, int] = {}
    for at, succ in zip(batch["at"].tolist(), batch["next"].tolist(), strict=True):
        leaves[at] = leaves.get(succ, succ)
    return batch[["file", "split", "at"]].assign(leaves=[leaves[x] for x in batch["at"].tolist()])


def _follow(batch: pd.DataFrame) -> pd.DataFrame:
    """Of one split: the candidates on the chains from its reached entries."""
    succ = dict(zip(batch["at"].tolist(), batch["next"].tolist(), strict=True))
    on: set[int] = set()
    for at in batch.loc[batch["entry"], "at"].tolist():
        while at in succ and at not in on:
            on.add(at)
            at = succ[at]
    return batch[["file", "split", "at"]][batch["at"].isin(on)]


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of read_archives; what it could not read is left out."""
    return read_archives(spark, path, payloads)[0]


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of all archives under path.

    Records: file, at (offset of the header), type, page_id, refers_to, uri, digest (as written),
    payload_bytes and payload_digest (of the payload that is there), and with payloads=True the
    payload itself. Rejects: file, at and bytes of what no record could be read from up to the
    file's end, such as a record cut off or all that stands behind a broken length.

    Files are read in splits. Every magic is a candidate, also one inside a payload. Its header tells
    where the next record must begin. Chains are followed inside each split, and pointer jumping
    over what leaves the splits finds the candidates that can be reached from the start of the
    file; the others are bytes of some payload. Only these offsets are shuffled. A payload that
    holds a magic, or crosses splits, is put together from its segments. Nothing leads to what follows a
    broken length: it is one reject. Files without records give no records, empty files no reject.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    segments = _segments(spark, path)
    totals = segments.groupBy("file_path", "file_block_start").agg(F.sum(F.octet_length("value") + len(MAGIC)).alias("size"))
    before = Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(totals.select(F.col("file_path").alias("file"), F.col("file_block_start").alias("split"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "bases")
    found = segments.mapInArrow(_candidates, CANDIDATE).join(bases, ["file", "split"])
    found = materialize(found.withColumns({c: F.col(c) + F.col("base") for c in ("at", "next", "block_at")}).drop("base"), "candidates")
    chains = materialize(found.select("file", "split", "at", "next").groupBy("file", "split").applyInPandas(_chains, "file string, split long, at long, leaves long"), "chains")
    start = chains.where(F.col("at") == len(MAGIC)).select("file", "at")
    entries = start.unionByName(chains.select("file", F.col("leaves").alias("at"))).distinct()
    jump = materialize(chains.join(entries, ["file", "at"]).select("file", "at", "leaves"), "entries")
    reached, count = start, -1
    while True:
        further = reached.join(jump, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        reached = materialize(reached.unionByName(further).distinct(), "reached")
        now = reached.count()
        if now == count:
            break
        count = now
        ahead = jump.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("far"))
        jump = materialize(jump.join(ahead, ["file", "leaves"], "left").select("file", "at", F.coalesce("far", "leaves").alias("leaves")), "jump")
    marked = found.select("file", "split", "at", "next").join(reached.withColumn("entry", F.lit(True)), ["file", "at"], "left").fillna(False, ["entry"])
    real = marked.groupBy("file", "split").applyInPandas(_follow, "file string, split long, at long")
    records = materialize(found.join(real, ["file", "split", "at"]), "records")
    wanted = records if payloads else records.where("NOT whole")
    parts = _assembled(spark, path, wanted, bases).select("file", "at", *(["payload"] if payloads else []), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d")) if payloads or not wanted.isEmpty() else None
    if parts is not None:
        records = records.join(parts, ["file", "at"], "left").withColumns({"payload_bytes": F.coalesce("payload_bytes", "n"), "payload_digest": F.coalesce("payload_digest", "d")}).drop("n", "d")
    records = records.where("payload_bytes IS NOT NULL")
    ends = totals.groupBy(F.col("file_path").alias("file")).agg(F.sum("size").alias("end"))
    read = ends.join(records.groupBy("file").agg(F.max("next").alias("read")), "file", "left").fillna(len(MAGIC), ["read"])
    rejects = read.where("read < end").select("file", (F.col("read") - len(MAGIC)).alias("at"), (F.col("end") - F.col("read")).alias("bytes"))
    return records.withColumn("at", F.col("at") - len(MAGIC)).drop("split", "next", "block_at", "whole"), rejects


def full_payloads(records: DataFrame) -> DataFrame:
    """Records of read_records with payload_bytes and payload_digest of the whole payload.

    A revisit carries none; it takes those of the response that it names and whose digest its own
    header repeats. So a page id with several payloads is told apart, and a revisit of
    something that is not there gets NULLs. Only revisits are joined, each response once, and a
    response that most of the table revisits is spread.
    """
    records = materialize(records, "read-records")
    revisit = F.col("type").eqNullSafe("revisit")
    own = F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest")
    first = records.where(~revisit).groupBy(*own).agg(F.max("payload_bytes").alias("n"))
    again = lookup_join(records.where(revisit).drop("payload_bytes", "payload_digest"), first, ["refers_to", "digest"], "left")
    again = again.withColumns({"payload_bytes": F.col("n"), "payload_digest": F.when(F.col("n").isNotNull(), F.col("digest"))})
    return records.where(~revisit).unionByName(again.select(*records.columns))


def _assembled(spark: SparkSession, path: str, wanted: DataFrame, bases: DataFrame) -> DataFrame:
    """file, at, payload, payload_bytes and payload_digest of the wanted records, from every
    segment that their blocks touch."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        for batch in batches:
            offsets = []
            for file, split, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, split) != here:
                    here, at = (file, split), 0
                offsets.append(at)
                at += len(value) + len(MAGIC)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(offsets, pa.int64())], names=["file", "split", "value", "offset"])

    def joined(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("offset")
        one = batch.iloc[0]
        text = MAGIC.encode().join(batch["value"])
        begin = int(one["block_at"] - one["offset"])
        end = int(one["next"] - one["offset"]) - len(RECORD_END) - len(MAGIC)
        if end > len(text):  # cut off by the file's end
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("file", str), ("at", int), ("payload", object), ("payload_bytes", int), ("payload_digest", str))})
        payload = _payload(text[begin:end])
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        return pd.DataFrame({"file": [one["file"]], "at": [one["at"]], "payload": [payload], "payload_bytes": [len(payload)], "payload_digest": [digest]})

    segments = _segments(spark, path).mapInArrow(placed, "file string, split long, value binary, offset long")
    segments = segments.join(bases, ["file", "split"]).select("file", F.col("split").alias("s"), "value", (F.col("offset") + F.col("base")).alias("offset"))
    # a record's segments lie in a run of slices of the file of 64 KB
    spans = wanted.select("file", "at", "next", "block_at", F.explode(F.sequence(F.shiftright("at", 16), F.shiftright("next", 16))).alias("slice"))
    cut = segments.withColumn("slice", F.shiftright("offset", 16)).join(spans, ["file", "slice"]).where("offset >= at AND offset < next")
    return cut.drop("slice", "s").groupBy("file", "at").applyInPandas(joined, "file string, at long, payload binary, payload_bytes long, payload_digest string")
