"""Readers for landed files and response bodies."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming import DataStreamReader

from ledgerloom.functions.dates import epoch_millis, normalize_date
from ledgerloom.functions.text import first_non_empty, strip
from ledgerloom.operators.dedup import first_per_key
from ledgerloom.operators.page_order import BREAK, CYCLE, page_places
from ledgerloom.operators.ranking import first_success
from ledgerloom.operators.validate import CONTENT, record_schema
from ledgerloom.session import written

COMPANY = "name string, slug string, url string, team_size bigint, top_company boolean"
POST = (
    "struct<id:string,name:string,tagline:string,description:string,url:string,website:string,"
    "makers:array<struct<name:string>>>"
)
POST_PAGE = (
    f"page bigint, cursor string, data struct<posts:struct<edges:array<struct<node:{POST}>>,"
    "pageInfo:struct<hasNextPage:boolean,endCursor:string>>>"
)
PAPER = (
    "entry_id string, title string, authors array<struct<name:string>>, comment string, summary string, "
    "published timestamp"
)
REPO_STATS = "owner string, repo string, stargazers_count bigint"
RESPONSE = "key string, provider string, body string, error string, seq bigint"
BOARD = "platform string, token string, body string, error string"

GREENHOUSE = (
    "struct<jobs:array<struct<absolute_url:string,updated_at:string,title:string,location:struct<name:string>>>>"
)
LEVER = (
    "array<struct<hostedUrl:string,createdAt:bigint,text:string,categories:struct<location:string>>>"
)
ASHBY = (
    "struct<jobs:array<struct<jobUrl:string,applyUrl:string,publishedAt:string,title:string,"
    "location:string,isRemote:boolean>>>"
)


def payload_records(rows: DataFrame, record_type: str) -> DataFrame:
    """Typed records of one type from a table ``record_type, payload`` with JSON payloads.

    For records that were stored as text; a time that cannot be read is null.
    """
    text_times = record_schema(record_type).replace("timestamp", "string")
    parsed = rows.where(F.col("record_type") == record_type).select(F.from_json("payload", text_times).alias("r"))
    return parsed.select(
        "r.schemaVersion",
        "r.recordType",
        "r.source",
        F.col("r.content").try_cast(CONTENT[record_type]).alias("content"),
        F.col("r.collectedAt").try_cast("timestamp").alias("collectedAt"),
    )


def read_companies(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """A company snapshot. A single JSON array needs ``multiline`` and is read by one task per file;
    land large snapshots as JSON lines and pass ``multiline=False``. ``seq`` follows file order: path, then place in the file."""
    rows = spark.read.schema(COMPANY).option("multiLine", multiline).json(path)
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("seq", place)


def product_posts(pages: DataFrame) -> DataFrame:
    """Rows of paged product responses, ``seq`` in page and list order."""
    edges = pages.select("page", F.posexplode("data.posts.edges").alias("pos", "edge"))
    return edges.select("edge.node.*", F.struct("page", "pos").alias("seq"))


def pages_in_order(pages: DataFrame) -> DataFrame:
    """Landed product pages with ``page`` worked out from their cursors; a page that landed several times counts once.

    Pages behind a gap keep their order among themselves behind all pages before the gap; pages that lead round in a circle come
    last, without a place. ``page_places`` of ``operators/page_order`` reports both.
    """
    info = F.col("data.posts.pageInfo")
    links = pages.select(F.lit("").alias("feed"), "cursor", info["endCursor"].alias("end_cursor"), info["hasNextPage"].alias("has_next"))
    places = page_places(links)
    chain = F.struct((F.col("status") == CYCLE).alias("cycle"), (F.col("status") == BREAK).alias("broken"), "chain", "page")
    own = F.coalesce("cursor", F.lit(""))
    once = first_per_key(pages.drop("page").withColumn("cursor", own).withColumn("_body", F.to_json("data")), ["cursor"], "_body").drop("_body")
    return once.join(places.select("cursor", chain.alias("page")), "cursor")


def read_product_pages(spark: SparkSession, path: str, by_cursor: bool = False) -> DataFrame:
    """Posts of landed pages; ``seq`` follows the pages' given numbers, or their cursors (``cursor``: what a page was asked for by)."""
    pages = spark.read.schema(POST_PAGE).json(path)
    return product_posts(pages_in_order(pages) if by_cursor else pages)


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAPER).json(path)


RSS_ITEM = (
    "title string, link string, description string, `content:encoded` string, pubDate string, updated string, `dc:date` string"
)
ATOM_ENTRY = (
    "title string, link array<struct<_rel:string,_href:string>>, summary string, content string, published string, updated string, "
    "`dc:date` string"
)
_BROKEN = "_broken"
# An ampersand that starts none of XML's own references; inside CDATA it needs no escape.
_BARE_AMPERSAND = r"&(?!(?:#[0-9]+|#x[0-9a-fA-F]+|amp|lt|gt|quot|apos);)(?![^<]*\]\]>)"
_ENTRY = r"(?is)<(item|entry)\b[^>]*>.*?</\1\s*>"
_ENTRY_START = r"(?i)<(?:item|entry)\b"
_ITEM_TYPE = "struct<title:string,link:string,summary:string,raw_date:string>"
NO_BODY = "no body"
UNREADABLE_BODY = "unreadable body"
UNREADABLE_ENTRY = "unreadable entry"


def _item(title: Column, link: Column, summary: Column, date: Column) -> Column:
    return F.struct(
        title.alias("title"),
        strip(link).alias("link"),
        summary.alias("summary"),
        date.alias("raw_date"),
    )


def _rss(item: Callable[[str], Column]) -> Column:
    date = first_non_empty(item("pubDate"), item("updated"), item("dc:date"))
    return _item(item("title"), item("link"), first_non_empty(item("description"), item("content:encoded")), date)


def _atom(entry: Callable[[str], Column]) -> Column:
    """The link is the first one to the entry's own page; enclosures and the like are other things."""
    own = F.filter(entry("link"), lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
    date = first_non_empty(entry("published"), entry("updated"), entry("dc:date"))
    return _item(entry("title"), F.get(own, F.lit(0))["_href"], first_non_empty(entry("summary"), entry("content")), date)


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


# Kind of feed -> element of an entry, its schema, and its item.
FEED_KINDS = {"rss": ("item", RSS_ITEM, _rss), "atom": ("entry", ATOM_ENTRY, _atom)}
CUT_OFF_ENTRY = "cut-off entry"


def _file_rows(reader: DataFrameReader | DataStreamReader, path: str, kind: str) -> DataFrame:
    """file, item and reject_reason of every entry that the XML reader finds; a broken one is read again with its bare ampersands escaped."""
    tag, schema, item = FEED_KINDS[kind]
    # The parser that cuts a file at its row tags gives each broken entry alone; the other one gives the whole file for each.
    options = {"rowTag": tag, "columnNameOfCorruptRecord": _BROKEN, "mode": "PERMISSIVE", "useLegacyXMLParser": "true"}
    whole = f"{schema}, {_BROKEN} string"
    rows = reader.format("xml").options(**options).schema(whole).load(path).select("*", F.col("_metadata.file_path").alias("_file"))
    again = F.from_xml(F.regexp_replace(_BROKEN, _BARE_AMPERSAND, "&amp;"), whole, {"columnNameOfCorruptRecord": _BROKEN})
    rows = rows.withColumn("again", F.when(F.col(_BROKEN).isNotNull(), again))
    lost = F.col(_BROKEN).isNotNull() & (F.col("again").isNull() | F.col("again")[_BROKEN].isNotNull())
    reason = F.when(F.col(_BROKEN).rlike(rf"(?i)</{tag}\s*>\s*$"), F.lit(UNREADABLE_ENTRY)).otherwise(F.lit(CUT_OFF_ENTRY))
    found = F.when(F.col(_BROKEN).isNull(), item(_column).cast(_ITEM_TYPE)).otherwise(item(lambda name: F.col("again")[name]).cast(_ITEM_TYPE))
    return rows.select(F.col("_file").alias("file"), found.alias("item"), F.when(lost, reason).alias("reject_reason"))


def _file_items(rows: DataFrame, source: str) -> DataFrame:
    return rows.where(F.col("reject_reason").isNull()).select(F.lit(source).alias("source"), "item.*")


def read_rss(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Items of RSS files: ``source, title, link, summary, raw_date``. What cannot be read is in ``rejected_file_entries``."""
    return _file_items(_file_rows(spark.read, path, "rss"), source)


def read_atom(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Entries of Atom files, in the same columns as ``read_rss``."""
    return _file_items(_file_rows(spark.read, path, "atom"), source)


def stream_feed(spark: SparkSession, path: str, source: str, kind: str, archive: str | None = None) -> DataFrame:
    """The items of feed files as they land. With ``archive``, files that are done move there, so that the landing folder stays small."""
    reader = spark.readStream
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _file_items(_file_rows(reader, path, kind), source)


def rejected_file_entries(spark: SparkSession, path: str, source: str, kind: str) -> DataFrame:
    """``source, file, reject_reason, n``: the broken entries of each feed file, and those that its end cuts off.

    An entry that the XML reader gives no row for is found by the count of the entries' start tags, line by line.
    """
    rows = written(_file_rows(spark.read, path, kind), "feed-entries")
    broken = rows.where(F.col("reject_reason").isNotNull()).groupBy("file", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
    start = F.regexp_count("value", F.lit(rf"(?i)<{FEED_KINDS[kind][0]}\b"))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), start.alias("n"))
    started = lines.groupBy("file").agg(F.sum("n").alias("started"))
    read = rows.groupBy("file").agg(F.count(F.lit(1)).alias("read"))
    missing = F.col("started") - F.coalesce("read", F.lit(0))
    unread = started.join(read, "file", "left").where(missing > 0).select("file", F.lit(CUT_OFF_ENTRY).alias("reject_reason"), missing.alias("n"))
    lost = broken.unionByName(unread).groupBy("file", "reject_reason").agg(F.sum("n").alias("n"))
    return lost.select(F.lit(source).alias("source"), "file", "reject_reason", "n")


def _entries(landed: DataFrame) -> DataFrame:
    """One row per entry: ``source, seq, item, reject_reason``.

    A body that is no XML is read again with its bare ampersands escaped; if that fails too, its complete
    entries are read one by one.
    """
    options = {"columnNameOfCorruptRecord": _BROKEN}
    schema = (
        f"channel struct<item:array<struct<{RSS_ITEM}>>>, item array<struct<{RSS_ITEM}>>, "
        f"entry array<struct<{ATOM_ENTRY}>>, {_BROKEN} string"
    )
    escaped = F.regexp_replace("body", _BARE_AMPERSAND, "&amp;")
    rows = landed.select("source", "body", F.from_xml("body", schema, options).alias("strict"))
    again = F.when(F.col("body").isNull() | F.col(f"strict.{_BROKEN}").isNotNull(), F.from_xml(escaped, schema, options))
    rows = rows.withColumn("feed", F.coalesce(again, "strict")).withColumn("escaped", escaped)
    rss = F.transform(F.coalesce("feed.channel.item", "feed.item"), lambda i: _rss(lambda name: i[name]))
    atom = F.transform("feed.entry", lambda e: _atom(lambda name: e[name]))
    found = F.regexp_extract_all("escaped", F.lit(_ENTRY), F.lit(0))
    cut_off = F.when(F.regexp_count("escaped", F.lit(_ENTRY_START)) > F.size(found), F.array(F.lit("")))
    fragments = F.concat(found, F.coalesce(cut_off, F.array().cast("array<string>")))
    unknown = F.lit(None).cast(_ITEM_TYPE)
    no_text = F.lit(None).cast("string")
    row = lambda item, text, reason: F.struct(item.alias("item"), text.alias("text"), reason.alias("reason"))
    broken = F.col(f"feed.{_BROKEN}").isNotNull()
    entries = (
        F.when(F.col("body").isNull(), F.array(row(unknown, no_text, F.lit(NO_BODY))))
        .when(broken & (F.size(fragments) == 0), F.array(row(unknown, no_text, F.lit(UNREADABLE_BODY))))
        .when(broken, F.transform(fragments, lambda text: row(unknown, text, no_text)))
        .otherwise(F.transform(F.coalesce(rss, atom), lambda item: row(item.cast(_ITEM_TYPE), no_text, no_text)))
    )
    each = rows.select("source", F.posexplode(entries).alias("seq", "e")).select("source", "seq", "e.*")
    alone = f"{RSS_ITEM.replace('link string', 'link array<struct<_VALUE:string,_rel:string,_href:string>>')}, summary string, content string, published string, {_BROKEN} string"
    each = each.withColumn("one", F.from_xml("text", alone, options))
    part = lambda name: F.col("one")[name]
    own = F.filter(part("link"), lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    first = F.get(own, F.lit(0))
    summary = first_non_empty(part("description"), part("summary"), part("content:encoded"), part("content"))
    date = first_non_empty(part("pubDate"), part("published"), part("updated"), part("dc:date"))
    single = _item(part("title"), first_non_empty(first["_href"], first["_VALUE"]), summary, date)
    unreadable = F.when(F.col("text").isNotNull() & part(_BROKEN).isNotNull(), F.lit(UNREADABLE_ENTRY))
    reason = F.coalesce("reason", unreadable)
    item = F.when(F.col("text").isNull(), F.col("item")).otherwise(single.cast(_ITEM_TYPE))
    return each.select("source", "seq", item.alias("item"), reason.alias("reject_reason"))


def feed_items(landed: DataFrame) -> DataFrame:
    """Items of landed feed bodies (``source, body``), RSS and Atom; ``seq`` is the list position.

    What cannot be read is in ``rejected_entries``.
    """
    return _entries(landed).where(F.col("reject_reason").isNull()).select("source", "seq", "item.*")


def rejected_entries(landed: DataFrame) -> DataFrame:
    """``source, seq, reject_reason`` of bodies and entries that cannot be read; ``seq`` is null for a whole body."""
    lost = _entries(landed).where(F.col("reject_reason").isNotNull())
    seq = F.when(F.col("reject_reason") == UNREADABLE_ENTRY, F.col("seq"))
    return lost.select("source", seq.alias("seq"), "reject_reason")


def union_feeds(feeds: Mapping[str, Callable[[str], DataFrame] | DataFrame]) -> DataFrame:
    """All items of the feeds that can be read, each labelled with its source; a failed feed is skipped."""
    merged = None
    for source, feed in feeds.items():
        try:
            items = feed(source) if callable(feed) else feed
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        merged = items if merged is None else merged.unionByName(items)
    if merged is None:
        raise ValueError("no feed could be read")
    return merged


def board_responded(platform: Column, body: Column, error: Column) -> Column:
    """True when a board answered in its own shape, an empty or absent list of jobs included; null for the list is no answer."""
    keys = F.json_object_keys(body)
    listed = F.json_array_length(F.get_json_object(body, "$.jobs")).isNotNull()
    shaped = F.when(platform == "lever", F.json_array_length(body).isNotNull()).otherwise(
        keys.isNotNull() & (~F.array_contains(keys, "jobs") | listed)
    )
    return error.isNull() & F.coalesce(shaped, F.lit(False))


def first_boards(candidates: DataFrame, landed: DataFrame) -> DataFrame:
    """Per company the first candidate board that responded; companies without one are left out."""
    tried = candidates.join(landed, ["platform", "token"])
    responded = board_responded(F.col("platform"), F.col("body"), F.col("error"))
    # Of several landings of one board the greatest body counts, so that the choice does not depend on the order of rows.
    once = tried.where(responded).groupBy("company", "rank", "platform", "token").agg(F.max("body").alias("body"))
    return first_success(once, ["company"], "rank", F.lit(True), ["platform", "token", "body"])


def _job(url: Column, published: Column, title: Column, location: Column, remote: Column, raw_date: Column | None = None) -> Column:
    return F.struct(
        url.alias("job_url"),
        published.alias("published"),
        title.alias("title"),
        location.alias("location"),
        remote.alias("remote"),
        (F.lit(None).cast("string") if raw_date is None else raw_date).alias("raw_date"),
    )


def _greenhouse(job: Column, now: Column) -> Column:
    unknown = F.lit(None).cast("boolean")
    date = normalize_date(job["updated_at"], now)
    return _job(job["absolute_url"], date, job["title"], job["location"]["name"], unknown, job["updated_at"])


def _lever(job: Column, now: Column) -> Column:
    unknown = F.lit(None).cast("boolean")
    return _job(job["hostedUrl"], epoch_millis(job["createdAt"]), job["text"], job["categories"]["location"], unknown)


def _ashby(job: Column, now: Column) -> Column:
    url = first_non_empty(job["jobUrl"], job["applyUrl"])
    date = normalize_date(job["publishedAt"], now)
    return _job(url, date, job["title"], job["location"], job["isRemote"], job["publishedAt"])


# Platform -> (schema of the body, field with the job list or null for a bare list, mapping of a job).
DIALECTS: dict[str, tuple[str, str | None, Callable[[Column, Column], Column]]] = {
    "greenhouse": (GREENHOUSE, "jobs", _greenhouse),
    "lever": (LEVER, None, _lever),
    "ashby": (ASHBY, "jobs", _ashby),
}


def board_jobs(boards: DataFrame, now: Column, dialects=None) -> DataFrame:
    """Jobs of all boards in one schema, in one pass; ``seq`` is the list position."""

    def mapped(schema: str, field: str | None, mapping: Callable[[Column, Column], Column]) -> Column:
        parsed = F.from_json("body", schema)
        return F.transform(parsed if field is None else parsed[field], lambda job: mapping(job, now))

    jobs = F.lit(None)
    for platform, dialect in (dialects or DIALECTS).items():
        jobs = F.when(F.col("platform") == platform, mapped(*dialect)).otherwise(jobs)
    return boards.select("company", "platform", F.posexplode(jobs).alias("seq", "job")).select(
        "company", "platform", "seq", "job.*"
    )


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE).json(path)
