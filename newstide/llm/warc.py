"""WARC archives: writing records, and reading them back with boundary-chain verification.

Writing is Spark's text writer: a record is its header and payload, and the two line ends that close it are the line
separator, so that files are committed like any other output and live in any store that Spark writes to.

Reading cuts the files at lines that start with the record magic, with Spark's text reader, which splits large files between
tasks. Within a line of a header, as in a url, the magic does not cut. A line of a payload may start with it as well, so a
place where one does is only a candidate. Each task gives the candidates of its
split with the offset of the record that would follow. Candidates whose record ends where the next one starts form runs;
what is left is one jump per run, from where it is entered to where its last record ends. Pointer jumping over these from
offset zero of every file keeps the records that can be reached, and drops candidates inside payloads.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newstide.session import cut, stage

MAGIC = "WARC/1."
#: Every record but a file's first follows the line ends that close the one before.
CUT = "\n" + MAGIC
CRLF = "\r\n"
DATE = "2025-01-01T00:00:00Z"
#: Payloads from this many bytes on are written once and then referred to.
REVISIT_BYTES = 100


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` with payload (null counts as empty), digest, record_type and refers_to.

    Of records with equal payloads of at least ``least`` bytes the one with the smallest ``page_id`` is the response; rows
    that share that id are all responses. Null ids are greater than others; where all are null, all are responses.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    pages = pages.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    # Only digests that occur more than once; staged, so that a payload shared by very many rows can be split in the join.
    shared = pages.where(F.col("bytes") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id")).where("n > 1")
    shared = stage(shared.select("digest", "first_id"), "shared")
    rows = pages.join(shared, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("first_id"))).drop("first_id")


def record_text(one_line: Column) -> Column:
    """A whole record but for the two line ends that close it."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    lines = F.concat_ws(
        CRLF,
        F.lit(f"{MAGIC}1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), one_line),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return F.concat(lines, F.lit(CRLF * 2), body)


def write_pages(pages: DataFrame, path: str) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to WARC files under ``path``; line ends in urls become spaces."""
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]+", " ")
    revisits(pages).select(record_text(url).alias("value")).write.option("lineSep", CRLF * 2).text(path)


def _header(name: str) -> Column:
    return F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece of the files from one cut to the next, with its place, and the length its header asks for.

    ``bytes`` is the piece's length, ``asked`` that of the record it would be; a piece that cannot be a record has none.
    ``place`` numbers the pieces of a split in order. The first piece of a file has the magic in it: where it can be that one,
    ``lead`` is the number of bytes before the magic, and ``value`` what follows it; ``data`` is always the whole piece.
    """
    text = spark.read.option("lineSep", CUT).text(path)
    rows = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumn("data", F.col("value").cast("binary")).withColumn("bytes", F.octet_length("data").cast("long"))
    # Whether a piece is the first is known later, in ``verified``; others of a first split may look like it.
    at = F.when((F.col("split") == 0) & ~F.col("value").rlike("^[01]\r\n"), F.locate(MAGIC, F.col("value")))
    rows = rows.withColumn("lead", F.when(at > 0, F.octet_length(F.substring("value", F.lit(1), at - 1))))
    rows = rows.withColumn("value", F.when(F.col("lead").isNull(), F.col("value")).otherwise(F.expr(f"cast(substring(data, lead + {len(MAGIC) + 1}) as string)")))
    # Headers of any real record end within the first bytes; the search for their end is a plain one. Its last byte may be the
    # first of the cut, where a payload starts with the magic.
    end = F.locate(CRLF * 2, F.concat("value", F.lit("\n")))
    rows = rows.withColumn("head", F.when(F.col("value").rlike("^[01]\r\n") & (end > 0), F.substring("value", F.lit(1), end + 1)))
    rows = rows.withColumn("head_bytes", F.octet_length("head") + 2)
    rows = rows.withColumn("length", F.expr("try_cast(regexp_extract(head, '(?im)^content-length:[ \\t]*([0-9]+)[ \\t]*\\r?$', 1) AS BIGINT)"))
    return rows.withColumn("asked", len(MAGIC) + F.col("head_bytes") + F.col("length") + 4)


def verified(pieces: DataFrame) -> DataFrame:
    """``pieces`` (file, split, place, bytes, lead, asked, ...) with ``offset``, the place of a piece's magic, and ``own``, the
    same for pieces that are reachable records; ``total`` is the distance to the next magic."""
    in_split = Window.partitionBy("file", "split").orderBy("place")
    # The first piece of a file follows no cut; it holds the magic itself, or is what stands before the first cut.
    first = (F.col("split") == 0) & (F.row_number().over(in_split) == 1)
    rows = pieces.withColumn("first", first)
    rows = rows.withColumn("asked", F.when(F.col("first") == F.col("lead").isNotNull(), F.col("asked")))
    rows = rows.withColumn("headless", F.col("first") & F.col("lead").isNull())
    rows = rows.withColumn("lead", F.when(F.col("first"), F.coalesce("lead", F.lit(0))).otherwise(1).cast("long"))
    rows = rows.withColumn("bytes", F.col("bytes") + F.when(F.col("first"), 0).otherwise(len(CUT)))
    rows = rows.withColumn("total", F.col("bytes") + 1 - F.col("lead"))
    rows = rows.withColumn("local", F.sum("bytes").over(in_split) - F.col("bytes"))
    # A run goes on while records end where the next piece's magic is; the last of a file ends a byte before, with the file.
    follows = F.coalesce(F.col("asked") == F.col("total"), F.lit(False))
    rows = rows.withColumn("follows", follows).withColumn("closed", follows | F.coalesce(F.col("asked") == F.col("total") - 1, F.lit(False)))
    starts_run = ~F.coalesce(F.lag("follows").over(in_split), F.lit(False))
    rows = rows.withColumn("run", F.sum(starts_run.cast("int")).over(in_split))
    rows = stage(rows, "pieces")

    # Splits are few; their sizes give every piece its offset in the file.
    sizes = rows.groupBy("file", "split").agg(F.sum("bytes").alias("size"))
    sizes = sizes.select("file", "split", (F.sum("size").over(Window.partitionBy("file").orderBy("split")) - F.col("size")).alias("base"))
    rows = rows.join(sizes, ["file", "split"]).withColumn("offset", F.col("base") + F.col("local") + F.col("lead"))
    runs = rows.groupBy("file", "split", "run").agg(F.min("offset").alias("from"), F.max_by(F.col("offset") + F.col("asked"), "offset").alias("to"), F.max("offset").alias("last"))
    runs = cut(runs.select("file", "split", "run", "from", "last", "to"))

    # Nodes are the places where a run can be entered: file starts, and where the last record of some run ends.
    entered = runs.where("to is not null").select("file", F.col("to").alias("at"))
    heads = rows.where("first").select("file", (F.col("offset") + F.when(F.col("headless"), F.col("total")).otherwise(0)).alias("at"), F.lit(True).alias("head"))
    nodes = heads.unionByName(entered.withColumn("head", F.lit(False))).groupBy("file", "at").agg(F.max("head").alias("head"))
    entries = rows.where("asked is not null").select("file", "offset", "split", "run")
    nodes = nodes.join(entries, (nodes["file"] == entries["file"]) & (nodes["at"] == entries["offset"])).select(nodes["file"], "at", "head", "split", "run")
    nodes = cut(nodes.join(runs.select("file", "split", "run", "to"), ["file", "split", "run"]).select("file", "split", "run", "at", F.col("to").alias("next"), F.col("head").alias("hit")))

    # Pointer jumping: after k rounds a node knows the one 2**k jumps on, and all nodes up to 2**k jumps from the start are hit.
    jump = nodes.select("file", "at", "next", "hit")
    while True:
        marked = jump.where("hit and next is not null").select("file", F.col("next").alias("at"), F.lit(True).alias("now"))
        known = jump.join(marked, ["file", "at"], "left").withColumn("hit", F.col("hit") | F.coalesce("now", F.lit(False))).drop("now")
        ahead = jump.select("file", F.col("at").alias("next"), F.col("next").alias("then"))
        jump = cut(known.join(ahead, ["file", "next"], "left").select("file", "at", F.col("then").alias("next"), "hit"))
        if not jump.where("next is not null").limit(1).count():
            break
    hits = nodes.drop("next", "hit").join(jump.where("hit").select("file", "at"), ["file", "at"])
    reached = hits.groupBy("file", "split", "run").agg(F.min("at").alias("enter"))
    rows = rows.join(reached, ["file", "split", "run"], "left")
    rows = rows.withColumn("own", F.when((F.col("offset") >= F.col("enter")) & F.col("asked").isNotNull(), F.col("offset")))
    return rows


@contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Fix the number of cores that splits are made for, which would else change where executors are lost between two reads."""
    name = "spark.sql.files.minPartitionNum"
    unset = spark.conf.get(name, None) is None
    if unset:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(name)


def read_records(spark: SparkSession, path: str, **derived) -> DataFrame:
    """Reachable records of the WARC files at ``path``: file, offset, head (the header) and ``derived``, columns made from the
    payload as binary by the given functions; ``payload`` itself by default. Empty files have no records.

    The chain of a file ends at the first record whose header cannot be read or whose payload is cut short.
    """
    derived = derived or {"payload": lambda c: c}
    rows = candidates(spark, path)
    body = lambda data, head, length: F.expr(f"substring({data}, {head} + 1, int({length}))")
    whole = (F.col("asked") - len(MAGIC) - F.octet_length("value")).isin(0, 1)
    made = [F.when(whole, fn(body("cast(value as binary)", "head_bytes", "length"))).alias(f"made_{n}") for n, fn in derived.items()]
    # Payloads that lie whole in a piece are dealt with where they are read; only the others travel.
    rows = rows.select("file", "split", "place", "head", "head_bytes", "length", "bytes", "lead", "asked", *made)
    with same_splits(spark):
        rows = verified(rows)
        done = rows.where("own is not null and closed").select("file", F.col("own").alias("offset"), "head", *[F.col(f"made_{n}").alias(n) for n in derived])

        # Records with a cut in their payload: the pieces from the header's on, in order, make up the payload. Pieces not
        # closed are few; closed ones inside a payload are read again only for files that have such records.
        open_ = cut(rows.where("own is not null and not closed").select("file", F.col("own").alias("from"), (F.col("own") + F.col("asked")).alias("to"), "head", "head_bytes", "length"))
        if not open_.limit(1).count():
            return done
        texts = candidates(spark, path).select("file", "split", "place", "data", F.col("value").cast("binary").alias("value"))
        places = rows.select("file", "split", "place", "first", "offset").join(open_, "file").where("offset >= from and offset < to").select("file", "split", "place", "first", "offset", "from", "to", "head", "head_bytes", "length")
        pieces = texts.join(cut(places), ["file", "split", "place"]).withColumn("data", F.when(F.col("first"), F.col("value")).otherwise(F.col("data")))
        joined = pieces.groupBy("file", "from", "to", "head", "head_bytes", "length").agg(F.array_sort(F.collect_list(F.struct("offset", "data"))).alias("parts"))
        magic = F.lit(CUT).cast("binary")
        data = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, F.when(F.octet_length(acc) > 0, magic).otherwise(F.lit(b"")), p["data"]))
        joined = joined.withColumn("data", data).withColumn("rest", body("data", "head_bytes", "length")).where("octet_length(rest) = length")
        # Written while the splits are fixed: places found in the first read hold in the second.
        joined = stage(joined.select("file", F.col("from").alias("offset"), "head", *[fn(F.col("rest")).alias(n) for n, fn in derived.items()]), "joined")
    return done.unionByName(joined)


def described(records: DataFrame) -> DataFrame:
    """Records with page_id, record_type, refers_to and the digest that the header gives."""
    number = lambda name: F.expr(f"try_cast(regexp_extract(head, '(?im)^{name}:[ \\t]*<urn:page:([0-9-]*)>', 1) AS BIGINT)")
    return records.select(
        number("WARC-Record-ID").alias("page_id"),
        _header("WARC-Type").alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"),
        F.regexp_extract("head", r"(?im)^WARC-Payload-Digest:[ \t]*sha256:([0-9a-f]+)", 1).alias("digest"),
        *[c for c in records.columns if c not in ("file", "offset", "head")],
    )


def page_payloads(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record; a revisit has those of its response.

    The digest of a response is computed from its payload as read.
    """
    records = described(read_records(spark, path, payload_bytes=lambda c: F.octet_length(c).cast("long"), payload_digest=lambda c: F.sha2(c, 256)))
    records = stage(records, "records")
    own = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    again = records.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "digest")
    wanted = stage(again.select(F.col("refers_to").alias("page_id"), "digest").distinct(), "wanted")
    # Several rows may share an id; the digest tells which payload is meant. Staged, so that hot ones can be split.
    source = own.join(wanted, "page_id").where("payload_digest = digest").select(F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest", "digest").distinct()
    found = again.join(stage(source, "sources"), ["refers_to", "digest"], "left")
    return own.unionByName(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
