"""WARC records and archive verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlframe.operators import records as R
from crawlframe.plans.audit import audit_archives, audit_pending
from crawlframe.session import scratch_path
from crawlframe.sources import archives, warc_source
from workload import frames
from workload.frames import PROFILE
from workload.registry import query

NL = "chr(13) || chr(10)"
VIEW = "'https://www.gallery.example/view/' || page_id || '/'"
TARGET = (
    "CASE WHEN page_id % 10 = 0 THEN 'https://d.gallery.example/art/' || page_id"
    f" ELSE {VIEW} END"
)
_INFO_LINES = [
    "'software: Crawler/1.0 (linux)'",
    "'not a header'",
    "'wget-arguments: \"-e\" \"a:b\"'",
    "'gallery_scrape_attempt_id: 1'",
    "'gallery_scrape_attempt_id: ' || page_id",
    "'date: 2023-05-17T08:31:12+00:00'",
    "'gallery_submission: ' || page_id",
    "'program_identity_string: FQDN[host-' || (page_id % 5) || ']-PID[55]-VER[0.2.7]'",
    "''",
    "'late: value'",
]
INFO = " || ".join(f"{line} || {NL}" for line in _INFO_LINES)

# Every record of every archive, positions counted from the rendered headers.
RECORDS = f"""
    WITH parts AS (
      SELECT page_id, '/archive/' || page_id || '.warc' AS path, {TARGET} AS target,
             {INFO} AS info, 'GET / HTTP/1.1' || {NL} || 'Host: www.gallery.example'
               || {NL} || {NL} AS request
      FROM pages),
    sized AS (
      SELECT *,
        strlen('WARC/1.1' || {NL} || 'WARC-Type: warcinfo' || {NL}
          || 'WARC-Record-ID: <urn:warcinfo:' || page_id || '>' || {NL}
          || 'Content-Type: application/warc-fields' || {NL}
          || 'Content-Length: ' || strlen(info) || {NL} || {NL} || info || {NL} || {NL}) AS len1,
        strlen('WARC/1.1' || {NL} || 'WARC-Type: request' || {NL}
          || 'WARC-Record-ID: <urn:request:' || page_id || '>' || {NL}
          || 'Content-Type: application/http; msgtype=request' || {NL}
          || 'WARC-Target-URI: ' || target || {NL}
          || 'Content-Length: ' || strlen(request) || {NL} || {NL} || request || {NL} || {NL})
          AS len2
      FROM parts),
    record AS (
      SELECT path, CAST(0 AS BIGINT) AS position, '<urn:warcinfo:' || page_id || '>' AS
               warc_record_id, 'warcinfo' AS warc_type, 'application/warc-fields' AS content_type,
             CAST(NULL AS VARCHAR) AS warc_target_uri
      FROM sized
      UNION ALL
      SELECT path, len1, '<urn:request:' || page_id || '>', 'request',
             'application/http; msgtype=request', target FROM sized
      UNION ALL
      SELECT path, len1 + len2, '<urn:response:' || page_id || '>', 'response',
             'application/http; msgtype=response', target FROM sized)
"""
MAIN = (
    "warc_type = 'response' AND"
    " regexp_matches(warc_target_uri, '^https://www.gallery.example/view/[0-9]+/')"
)


def _records(spark, d):
    parsed = archives.with_records(frames.warc_files(spark, d))
    return archives.warc_records(parsed).drop("block")


@query("warc_records", RECORDS + "SELECT * FROM record")
def warc_records(spark, d):
    return _records(spark, d)


@query(
    "first_record_where",
    RECORDS
    + """
    SELECT p.path, r.position, warc_record_id, warc_type, content_type, warc_target_uri
    FROM (SELECT DISTINCT path FROM record) p
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY path ORDER BY position) AS rn
               FROM record WHERE warc_target_uri LIKE '%/view/%') r ON p.path = r.path AND rn = 1""",
)
def first_record(spark, d):
    """First record of each file that concerns an item page; files without one stay."""
    return R.first_record_where(_records(spark, d), F.col("warc_target_uri").contains("/view/"))


@query(
    "predicate_arg",
    RECORDS + "SELECT path, warc_record_id, warc_type FROM record WHERE warc_type = 'warcinfo'",
)
def predicate(spark, d):
    """The same choice made on the parsed file, with a caller's predicate and no shuffle."""
    parsed = archives.with_records(frames.warc_files(spark, d))
    info = R.first_record(R.is_warcinfo)
    return parsed.select("path", info.alias("r")).select("path", "r.warc_record_id", "r.warc_type")


@query("main_response", RECORDS + f"SELECT * FROM record WHERE {MAIN}")
def main(spark, d):
    return R.main_response(_records(spark, d), PROFILE)


@query(
    "record_index_jsonl",
    """
    SELECT page_id * 100 AS position, '<urn:' || page_id || '>' AS warc_record_id,
           'response' AS warc_type, 'text/html' AS content_type,
           CASE WHEN page_id % 4 <> 0 THEN url END AS warc_target_uri
    FROM pages""",
)
def index(spark, d):
    """Index lines written as text and read back."""
    uri = F.when(F.col("page_id") % 4 == 0, "null").otherwise(
        F.concat(F.lit('"'), F.col("url"), F.lit('"'))
    )
    lines = frames.table(spark, d, "pages").select(
        F.concat(
            F.lit("["),
            (F.col("page_id") * 100).cast("string"),
            F.lit(',"<urn:'),
            F.col("page_id").cast("string"),
            F.lit('>","response","text/html",'),
            uri,
            F.lit("]"),
        ).alias("value")
    )
    path = scratch_path(spark, "index")
    lines.write.text(path)
    return archives.record_index_jsonl(spark.read.text(path))


@query(
    "record_block",
    "SELECT doc_id, text AS block FROM documents",
)
def block(spark, d):
    """Texts cut into base64 chunk lines, put together again."""
    starts = F.sequence(F.lit(0), F.greatest(F.octet_length("text") - 1, F.lit(0)), F.lit(1000))
    # The bytes are made once and cut inside; a text beside each of its pieces would take
    # the square of its length in memory, as Spark holds all pieces of a row at once.
    cut = F.transform(
        F.array(F.col("text").cast("binary")),
        lambda data: F.transform(starts, lambda at: F.base64(F.substring(data, at + 1, F.lit(1000)))),
    )
    pieces = frames.table(spark, d, "documents").select("doc_id", F.posexplode(cut[0]).alias("n", "chunk"))
    lines = pieces.select(
        "doc_id",
        (F.col("n") + 1).cast("long").alias("line_no"),
        F.to_json(F.struct(F.struct(F.col("chunk").alias("data")).alias("BlockChunk"))).alias("value"),
    ).unionByName(
        frames.table(spark, d, "documents").select(
            "doc_id",
            F.lit(0).cast("long").alias("line_no"),
            F.lit('{"ExtractMetadata": {"is_truncated": false}}').alias("value"),
        )
    )
    joined = archives.record_block(lines, "doc_id", "line_no")
    return joined.withColumn("block", F.col("block").cast("string"))


@query(
    "warcinfo_headers",
    """
    WITH h AS (
      SELECT page_id, unnest([
        {'header': 'software', 'value': 'Crawler/1.0 (linux)'},
        {'header': 'wget-arguments', 'value': '"-e" "a:b"'},
        {'header': 'gallery_scrape_attempt_id', 'value': CAST(page_id AS VARCHAR)},
        {'header': 'date', 'value': '2023-05-17T08:31:12+00:00'},
        {'header': 'gallery_submission', 'value': CAST(page_id AS VARCHAR)},
        {'header': 'program_identity_string',
         'value': 'FQDN[host-' || (page_id % 5) || ']-PID[55]-VER[0.2.7]'}]) AS e
      FROM pages)
    SELECT '/archive/' || page_id || '.warc' AS path, e.header AS header, ' ' || e.value AS value FROM h""",
)
def headers(spark, d):
    parsed = archives.with_records(frames.warc_files(spark, d), ("warcinfo",))
    blocks = parsed.select(
        "path", R.first_record(R.is_warcinfo)["block"].cast("string").alias("text")
    )
    return R.warcinfo_headers(blocks, "path", "text")


@query(
    "parse_archives",
    f"""
    SELECT '/archive/' || page_id || '.warc' AS path, page_id AS attempt_id,
           page_id AS site_submission_id, 'host-' || (page_id % 5) AS host,
           CASE WHEN page_id % 10 <> 0 THEN {VIEW} END AS main_uri
    FROM pages""",
)
def parsed_archives(spark, d):
    rows = R.parse_archives(frames.warc_files(spark, d), PROFILE)
    return rows.select(
        "path", "attempt_id", "site_submission_id", F.col("worker.host").alias("host"), "main_uri"
    )


VERDICT = """CASE WHEN page_id % 10 = 0 THEN 'unknown'
                WHEN page_id % 10 IN (1, 2) THEN 'deleted' ELSE 'present' END"""


@query(
    "hole_verdict",
    f"""
    SELECT '/archive/' || page_id || '.warc' AS path, {VERDICT} AS submission_status FROM pages""",
)
def verdict(spark, d):
    return R.hole_verdict(frames.warc_files(spark, d), PROFILE).drop("sha512")


@query(
    "audit_archives",
    f"""
    SELECT CAST(3 AS BIGINT) AS run_id, 'finished' AS processed_status,
           '/archive/' || page_id || '.warc' AS file_path,
           CASE WHEN page_id % 10 NOT IN (0, 1, 2) AND html LIKE '%lang="fr"%' THEN 'maintenance'
                ELSE {VERDICT} END AS submission_status
    FROM pages""",
)
def audit(spark, d):
    """The whole audit; a caller's pattern stands in for the maintenance page."""
    pattern = '(?s)pageid-item.*lang="fr"'
    rows = audit_archives(frames.warc_files(spark, d), 3, PROFILE, maintenance=pattern)
    return rows.select("run_id", "processed_status", "file_path", "submission_status")


NAME = "regexp_extract(path, '([^/]*)$', 1)"
PER = frames.PAGES_PER_ARCHIVE
STORED_NAME = f"(page_id // {PER}) || '.warc' || CASE WHEN (page_id // {PER}) % 2 = 1 THEN '.gz' ELSE '' END"


def _file_name(path="path"):
    return F.regexp_extract(path, "([^/]*)$", 1)


@query(
    "warc_source",
    f"""
    SELECT {STORED_NAME} AS file, '<urn:response:' || page_id || '>' AS warc_record_id, {VIEW} AS warc_target_uri,
           CAST(0 AS INTEGER) AS chunk
    FROM pages WHERE page_id % 10 <> 0""",
)
def responses(spark, d):
    """Item pages of stored archives, by the data source: type and address are tested in the reader."""
    rows = warc_source.read_archives(
        spark, frames.archive_folder(spark, d), "path string, warc_record_id string, warc_type string, warc_target_uri string, chunk int"
    )
    pages = rows.filter((F.col("warc_type") == "response") & F.col("warc_target_uri").startswith("https://www.gallery.example/view/"))
    return pages.select(_file_name().alias("file"), "warc_record_id", "warc_target_uri", "chunk")


def _index(spark, d):
    """The index of stored archives, kept as a table: it is used more than once."""
    root, path = frames.archive_folder(spark, d), scratch_path(spark, "archive-index")
    made = warc_source.archive_index(archives.walk_tree(spark, root), spark.sparkContext.defaultParallelism)
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


@query(
    "archive_index",
    f"""
    SELECT {STORED_NAME} AS file, CAST(sum(3) AS BIGINT) AS n_records, min(page_id) AS first_page, max(page_id) AS last_page,
           CAST(count(*) FILTER (WHERE page_id % 10 <> 0) AS BIGINT) AS n_main
    FROM pages GROUP BY ALL""",
)
def index_of_archives(spark, d):
    """Per stored archive: records, the pages of its first and last one, main responses."""
    number = F.regexp_extract(F.col("record.warc_record_id"), "([0-9]+)", 1).cast("long")
    main = R.is_main_response(F.col("record"), PROFILE)
    rows = _index(spark, d).select(_file_name().alias("file"), F.explode("records").alias("record"))
    return rows.groupBy("file").agg(
        F.count("*").alias("n_records"),
        F.min(number).alias("first_page"),
        F.max(number).alias("last_page"),
        F.count_if(main).alias("n_main"),
    )


@query(
    "record_bodies",
    f"""
    SELECT {STORED_NAME} AS file, page_id, sha256({INFO}) AS info_sha256 FROM pages WHERE page_id % 7 = 3""",
)
def bodies(spark, d):
    """Header records of some pages, fetched by their byte ranges alone."""
    rows = _index(spark, d).select("path", F.explode("records").alias("record")).filter(R.is_warcinfo(F.col("record")))
    number = F.regexp_extract(F.col("record.warc_record_id"), "([0-9]+)", 1).cast("long")
    fetched = warc_source.record_bodies(rows.withColumn("page_id", number).filter("page_id % 7 = 3"))
    return fetched.select(_file_name().alias("file"), "page_id", F.sha2("block", 256).alias("info_sha256"))


STORED_VERDICT = f"""
    stored_verdict AS (
      SELECT {STORED_NAME} AS file,
             coalesce(arg_min({VERDICT}, page_id) FILTER (WHERE page_id % 10 <> 0), 'unknown') AS submission_status
      FROM pages GROUP BY ALL)"""


@query("indexed_verdict", f"WITH {STORED_VERDICT} SELECT file, submission_status FROM stored_verdict")
def verdict_by_ranges(spark, d):
    rows = R.indexed_verdict(_index(spark, d), PROFILE)
    return rows.select(_file_name().alias("file"), "submission_status")


@query(
    "audit_pending",
    f"""
    WITH {STORED_VERDICT}
    SELECT CAST(8 AS BIGINT) AS run_id, 'finished' AS processed_status, file, submission_status
    FROM stored_verdict WHERE CAST(string_split(file, '.')[1] AS BIGINT) % 3 <> 0""",
)
def audit_of_a_manifest(spark, d):
    """The second half of a run: every third archive is finished already and stays closed."""
    listing = archives.walk_tree(spark, frames.archive_folder(spark, d))
    number = F.regexp_extract("file_path", "([0-9]+)[^/]*$", 1).cast("long")
    manifest = archives.dir_manifest(listing, 8).withColumn(
        "processed_status", F.when(number % 3 == 0, "finished").otherwise("todo")
    )
    rows = audit_pending(manifest, 8, spark.sparkContext.defaultParallelism, PROFILE)
    return rows.select("run_id", "processed_status", _file_name("file_path").alias("file"), "submission_status")
