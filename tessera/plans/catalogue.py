"""The named queries of the library over the given tables, and the SQL each must agree with.

The tables stand in for the engine's: orders are submissions and lineitem rows their upload events, documents are raw
and canonical documents, labels their index states, embeddings indexed chunks, events timestamped registry updates.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, markdown, text, times
from ..operators import attach, chunking, dedupe, indexing, monitor, ordered, readiness as ready_ops, receipts, retrieval, review, validate, versions
from ..schemas import UPLOAD_EVENT
from ..sources import objects, registry
from ..session import checkpoint_folder, workers_find_library
from ..streaming import alarms
from ..streaming import receipts as streams

NOW = datetime(2024, 1, 30, 12, 0)
CHUNK = 4000
#: Parts of a scope whose chunks are scored apart.
SALTS = 16

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return workers_find_library(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files: one without a text is a file without bytes."""
    return read(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))


def now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def csv(values: Column) -> Column:
    return F.array_join(values, ",")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as receipts."""
    rows = read(spark, sf_dir, "lineitem")
    return rows.select(F.col("l_orderkey").alias("submissionId"), F.col("l_linenumber").alias("fileId"), F.col("l_shipdate").alias("ts"), "l_partkey")


def submission_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the files that lineitem has of them."""
    files = deliveries(spark, sf_dir).groupBy("submissionId").agg(F.array_sort(F.collect_set(F.col("fileId").cast("string"))).alias("fileIds"))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("submissionId"), F.col("o_orderstatus").alias("status")).join(files, "submissionId", "left")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents to distinct canonical ones, chunked: chunks and characters by document."""
    docs = dedupe.hashed(read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text")
    claimed = dedupe.claims(docs.select("doc_id", "rawFileHash"), empty_raw(spark), ("doc_id",)).where("ownershipClaimed")
    unique = docs.join(claimed.select("doc_id"), "doc_id", "left_semi")
    made = unique.select(keys.document_id(keys.content_hash(text.normalized(F.col("text")))).alias("documentId"), text.normalized(F.col("text")).alias("markdown")).dropDuplicates(["documentId"])
    return chunking.chunk_records(made, CHUNK).groupBy("documentId").agg(F.count("*").alias("chunks"), F.sum(F.length("content")).alias("chars"))


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "rawFileHash string, status string, documentId string, canonicalHash string")


# receipts and validation


@query("""
select l_orderkey as submission_id, count(*) as received_file_count, string_agg(f, ',' order by ts, l_linenumber) as file_ids, cast(sum(n) - count(*) as bigint) as duplicates_ignored
from (select l_orderkey, l_linenumber, cast(l_linenumber as varchar) f, min(l_shipdate) ts, count(*) n from lineitem group by 1, 2, 3) group by 1""")
def receipts_rollup(spark, sf_dir):
    found = receipts.submissions(deliveries(spark, sf_dir), ("ts", "fileId"))
    return found.select(F.col("submissionId").alias("submission_id"), F.col("receivedFileCount").alias("received_file_count"), csv(F.transform("fileIds", lambda x: x.cast("string"))).alias("file_ids"), F.col("duplicatesIgnored").cast("long").alias("duplicates_ignored"))


@query("select count(*) as deliveries, count(*) - count(distinct (l_orderkey, l_linenumber)) as ignored from lineitem")
def receipts_duplicates_ignored(spark, sf_dir):
    first = receipts.first_receipts(deliveries(spark, sf_dir), ("ts",))
    return first.agg(F.sum("deliveries").alias("deliveries"), (F.sum("deliveries") - F.count("*")).alias("ignored"))


@query("""
with k as (select l_orderkey, l_linenumber, case l_linenumber % 5 when 0 then 'processed/' when 1 then 'ingestion/' else 'ingestion/sub ' || l_orderkey || '/' end
  || case when l_linenumber % 5 = 3 then '' else 'dir/part ' || l_partkey || '.json' end as key from lineitem),
c as (select *, case when not starts_with(key, 'ingestion/') then 'ignored' when regexp_matches(key, '^ingestion/[^/]+/.+$') then 'recorded' else 'malformed' end as action from k)
select key, action, case when action = 'recorded' then regexp_extract(key, '^ingestion/([^/]+)/(.+)$', 1) end as submission_id,
  case when action = 'recorded' then regexp_extract(key, '^ingestion/([^/]+)/(.+)$', 2) end as file_id, count(*) as n from c group by all""")
def key_parse(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    kind = F.col("l_linenumber") % 5
    head = F.when(kind == 0, "processed/").when(kind == 1, "ingestion/").otherwise(F.format_string("ingestion/sub+%d/", "l_orderkey"))
    encoded = F.concat(head, F.when(kind == 3, "").otherwise(F.format_string("dir/part%%20%d.json", "l_partkey")))
    event = F.struct(F.lit("ObjectCreated:Put").alias("eventName"), F.struct(F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct(encoded.alias("key"), F.lit("0").alias("sequencer")).alias("object")).alias("s3"))
    found = receipts.classified(receipts.unnested(rows.select(F.array(event).alias("Records"))))
    return found.groupBy("key", "action", F.col("submissionId").alias("submission_id"), F.col("fileId").alias("file_id")).agg(F.count("*").alias("n"))


@query("""
with r as (select o_orderkey, coalesce(list_sort(list(distinct cast(l_linenumber as varchar)) filter (where l_linenumber is not null)), []) as actual from orders left join lineitem on l_orderkey = o_orderkey group by 1),
m as (select *, list_filter(['1', '2', '3', '4'], lambda x: not list_contains(actual, x)) as missing from r)
select o_orderkey as submission_id, len(missing) = 0 as is_valid, case when len(missing) > 0 then 'MISSING_FILES' else 'OK' end as reason, coalesce(array_to_string(missing, ','), '') as missing_files, coalesce(array_to_string(actual, ','), '') as actual_files from m""")
def submission_validation(spark, sf_dir):
    known = submission_registry(spark, sf_dir)
    asked = known.select("submissionId", F.array(*(F.lit(str(i)) for i in range(1, 5))).alias("expectedFileIds"))
    found = validate.validated(asked, known)
    return found.select(F.col("submissionId").alias("submission_id"), F.col("isValid").alias("is_valid"), "reason", csv(F.col("missingFileIds")).alias("missing_files"), csv(F.col("actualFileIds")).alias("actual_files"))


@query("""
select p as submission_id, case when o_orderkey is null then 'SUBMISSION_NOT_FOUND' when coalesce(n, 0) = 0 then 'MISSING_FILES' else 'OK' end as reason
from (select distinct l_partkey * 7 as p from lineitem) left join orders on o_orderkey = p left join (select l_orderkey, count(*) filter (where l_linenumber = 1) n from lineitem group by 1) on l_orderkey = p""")
def submission_not_found(spark, sf_dir):
    asked = deliveries(spark, sf_dir).select((F.col("l_partkey") * 7).alias("submissionId"), F.array(F.lit("1")).alias("expectedFileIds")).distinct()
    return validate.validated(asked, submission_registry(spark, sf_dir)).select(F.col("submissionId").alias("submission_id"), "reason")


# exact duplicates and canonical documents


def hashed_documents(spark, sf_dir) -> DataFrame:
    """doc_id and hash only: contents stay behind."""
    return dedupe.hashed(files(spark, sf_dir), "text").select("doc_id", "source", "rawFileHash")


@query("""
select doc_id, 'sha256:' || sha256(text) as raw_file_hash, row_number() over (partition by sha256(text) order by doc_id) = 1 as ownership_claimed,
  case when row_number() over (partition by sha256(text) order by doc_id) = 1 then 'raw_file_claimed' else 'raw_file_reused' end as action from (select * replace (coalesce(text, '') as text) from documents)""")
def raw_claims(spark, sf_dir):
    found = dedupe.claims(hashed_documents(spark, sf_dir), empty_raw(spark), ("doc_id",))
    return found.select("doc_id", F.col("rawFileHash").alias("raw_file_hash"), F.col("ownershipClaimed").alias("ownership_claimed"), "action")


@query("select 'sha256:' || sha256(text) as raw_file_hash, min(doc_id) as first_seen, max(doc_id) as last_seen, count(*) as deliveries from (select * replace (coalesce(text, '') as text) from documents) group by 1")
def raw_registry(spark, sf_dir):
    found = dedupe.seen(hashed_documents(spark, sf_dir), "doc_id")
    return found.select(F.col("rawFileHash").alias("raw_file_hash"), F.col("firstSeenAt").alias("first_seen"), F.col("lastSeenAt").alias("last_seen"), "deliveries")


def variants(spark, sf_dir) -> DataFrame:
    """Each text as it is and with other newlines: other bytes, the same canonical text."""
    docs = files(spark, sf_dir).select("doc_id", "source", "text")
    both = docs.select("*", F.lit(0).alias("variant")).unionByName(docs.select("doc_id", "source", F.replace("text", F.lit("\n"), F.lit("\r\n")).alias("text"), F.lit(1).alias("variant")))
    return both.select("doc_id", "source", "variant", keys.content_hash(F.col("text")).alias("rawFileHash"), keys.content_hash(text.normalized(F.col("text"))).alias("canonicalHash"))


def variants_at_rest(spark, sf_dir) -> DataFrame:
    """The same as files: texts are normalised and hashed once, however often a plan reads the rows."""
    import uuid

    folder = f"{checkpoint_folder(spark)}/variants-{uuid.uuid4().hex}"
    rows = variants(spark, sf_dir).drop("rawFileHash")
    rows.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def empty_documents(spark) -> DataFrame:
    return spark.createDataFrame([], "documentId string, canonicalHash string")


VARIANTS = """with v as (select doc_id, source, 0 as variant, text from (select * replace (coalesce(text, '') as text) from documents) union all select doc_id, source, 1, replace(text, chr(10), chr(13) || chr(10)) from (select * replace (coalesce(text, '') as text) from documents)),
h as (select doc_id, source, variant, 'sha256:' || sha256(text) as raw, 'sha256:' || sha256(trim(replace(text, chr(13) || chr(10), chr(10)), chr(10) || ' ' || chr(9))) as canonical from v)
"""


@query(VARIANTS + "select 'doc-' || substr(canonical, 8, 16) as document_id, canonical as canonical_hash, count(*) as files, count(distinct raw) as raw_files, min(doc_id) as first_doc from h group by 1, 2")
def canonical_registry(spark, sf_dir):
    found = dedupe.resolved(variants(spark, sf_dir), empty_documents(spark), ("doc_id", "variant"))
    return found.groupBy(F.col("documentId").alias("document_id"), F.col("canonicalHash").alias("canonical_hash")).agg(F.count("*").alias("files"), F.count_distinct("rawFileHash").alias("raw_files"), F.min("doc_id").alias("first_doc"))


@query(VARIANTS + ", c as (select source, row_number() over (partition by canonical order by doc_id, variant) = 1 as made from h) select source, count(*) filter (where made) as created, count(*) filter (where not made) as reused from c group by 1")
def canonical_reuse(spark, sf_dir):
    found = dedupe.resolved(variants(spark, sf_dir), empty_documents(spark), ("doc_id", "variant"))
    return found.groupBy("source").agg(F.count_if("created").alias("created"), F.count_if(~F.col("created")).alias("reused"))


@query(VARIANTS + """select a.doc_id as a, b.doc_id as b, a.raw = b.raw as raw_equal, a.canonical = b.canonical as canonical_equal
from (select * from h where variant = 0) a join (select * from h where variant = 1) b on a.doc_id = b.doc_id""")
def identity_compare(spark, sf_dir):
    rows = variants(spark, sf_dir)
    left = rows.where("variant = 0").select("doc_id", F.col("rawFileHash").alias("raw"), F.col("canonicalHash").alias("canonical"))
    right = rows.where("variant = 1").select("doc_id", "rawFileHash", "canonicalHash")
    both = left.join(right, "doc_id")
    return both.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"), (F.col("raw") == F.col("rawFileHash")).alias("raw_equal"), (F.col("canonical") == F.col("canonicalHash")).alias("canonical_equal"))


@query("""
select event_id, 'K: ' || json_extract_string(props, '$.k') as markdown,
 'sha256:' || sha256('{"markdownText":"K: ' || json_extract_string(props, '$.k') || '","normalizationStrategy":"json_to_markdown_lines_v2"}') as canonical_hash, 'dict' as top_level_type, cast(strlen(props) as bigint) as size_bytes from events""")
def render_documents(spark, sf_dir):
    # equal contents are rendered once: their hash is the key that the result is joined back by
    rows = read(spark, sf_dir, "events").select("event_id", keys.content_hash(F.col("props")).alias("h"), "props")
    unique = rows.groupBy("h").agg(F.first("props").alias("props"))
    made = unique.select("h", markdown.normalize_document(F.col("props").cast("binary")).alias("r"))
    return rows.select("event_id", "h").join(made, "h").select("event_id", "r.markdown", F.col("r.canonicalHash").alias("canonical_hash"), F.col("r.topLevelType").alias("top_level_type"), F.col("r.sizeBytes").alias("size_bytes"))


@query("select doc_id, cast(strlen(text) as bigint) as size_bytes, cast(length(text) as bigint) as chars, cast(case when text = '' then 0 else length(text) - length(replace(text, chr(10), '')) + 1 end as bigint) as lines from (select * replace (coalesce(text, '') as text) from documents)")
def extracted_metadata(spark, sf_dir):
    docs = files(spark, sf_dir)
    return docs.select("doc_id", F.octet_length("text").cast("long").alias("size_bytes"), F.length("text").cast("long").alias("chars"), text.line_count(F.col("text")).alias("lines"))


REGISTRY_SQL = """with h as (select doc_id, source, 'sha256:' || sha256(text) as raw from (select * replace (coalesce(text, '') as text) from documents)),
k as (select raw, min(doc_id) % 4 as kind from h group by raw having min(doc_id) % 4 <> 3),
c as (select doc_id, raw, kind, row_number() over (partition by raw order by doc_id) as turn from h left join k using (raw))
"""


@query(REGISTRY_SQL + """select doc_id, raw as raw_file_hash, case kind when 0 then 'RESOLVED' when 1 then 'FAILED' when 2 then 'PROCESSING' end as status, kind is null and turn = 1 as ownership_claimed,
  case when kind is null and turn = 1 then 'raw_file_claimed' when kind is null or kind = 0 then 'raw_file_reused' else 'raw_file_in_progress' end as action, case when kind = 0 then 'doc-' || substr(raw, 8, 16) end as document_id from c""")
def claims_on_registry(spark, sf_dir):
    """Claims where the registry holds most contents already: resolved, failed, and in progress."""
    rows = hashed_documents(spark, sf_dir)
    kind = F.col("least") % 4
    known = rows.groupBy("rawFileHash").agg(F.min("doc_id").alias("least")).where(kind != 3)
    status = F.when(kind == 0, "RESOLVED").when(kind == 1, "FAILED").otherwise("PROCESSING")
    held = known.select("rawFileHash", status.alias("status"), F.when(kind == 0, keys.document_id(F.col("rawFileHash"))).otherwise("").alias("documentId"), F.lit("").alias("canonicalHash"))
    found = dedupe.claims(rows, held, ("doc_id",))
    return found.select("doc_id", F.col("rawFileHash").alias("raw_file_hash"), F.col("rawFileStatus").alias("status"), F.col("ownershipClaimed").alias("ownership_claimed"), "action", F.col("documentId").alias("document_id"))


@query(VARIANTS + """, k as (select canonical, min(doc_id) as least from h group by canonical having min(doc_id) % 2 = 0)
select doc_id, variant, canonical as canonical_hash, coalesce('known-' || least, 'doc-' || substr(canonical, 8, 16)) as document_id, least is null and row_number() over (partition by canonical order by doc_id, variant) = 1 as created
from h left join k using (canonical)""")
def documents_on_registry(spark, sf_dir):
    """Canonical documents where the registry holds half of them under other ids: those are reused as they are."""
    rows = variants_at_rest(spark, sf_dir)
    known = rows.groupBy("canonicalHash").agg(F.min("doc_id").alias("least")).where("least % 2 = 0").select("canonicalHash", F.concat(F.lit("known-"), "least").alias("documentId"))
    found = dedupe.resolved(rows, known, ("doc_id", "variant"))
    return found.select("doc_id", "variant", F.col("canonicalHash").alias("canonical_hash"), F.col("documentId").alias("document_id"), "created")


#: An order with its lines as a nested document, as it is rendered.
NESTED_SQL = """with l as (select l_orderkey, list(l_linenumber order by l_linenumber, l_partkey) as numbers, list(l_partkey order by l_linenumber, l_partkey) as parts from lineitem group by 1),
o as (select o_orderkey, o_orderstatus, o_orderpriority, coalesce(numbers, []) as numbers, coalesce(parts, []) as parts from orders left join l on l_orderkey = o_orderkey),
m as (select o_orderkey, len(numbers) as n, concat('Report Id: order-', o_orderkey, chr(10), chr(10), 'Order Status: ', o_orderstatus, chr(10), chr(10), 'Is Open: ', case when o_orderstatus = 'O' then 'true' else 'false' end, chr(10), chr(10), 'Missing: null', chr(10), chr(10),
  'Note: |', chr(10), '  first', chr(10), '    ', o_orderpriority, chr(10), chr(10), 'Lines:', case when len(numbers) > 0 then chr(10) else '' end,
  array_to_string(list_transform(range(1, len(numbers) + 1), lambda i: concat('  -:', chr(10), '    Line Number: ', numbers[i], chr(10), chr(10), '    Part Keys:', chr(10), '      - ', parts[i], chr(10), chr(10), '      - p-', parts[i])), chr(10) || chr(10)),
  chr(10), chr(10), 'Meta Data:', chr(10), 'X Y: z') as markdown from o)
"""


@query(NESTED_SQL + """select o_orderkey as order_key, sha256(markdown) as markdown_sha256, 'sha256:' || sha256('{"markdownText":"' || replace(markdown, chr(10), chr(92) || 'n') || '","normalizationStrategy":"json_to_markdown_lines_v2"}') as canonical_hash,
  cast(1 + n as bigint) as segment_ids, cast(8 as bigint) as entries, cast(7 as bigint) as sanitized_entries, cast(length(markdown) - length(replace(markdown, chr(10), '')) + 1 as bigint) as lines, 'order-' || o_orderkey as business_key from m""")
def render_nested(spark, sf_dir):
    """Objects in lists in objects, texts of many lines, booleans, nulls and pruned keys at two depths."""
    line = F.struct(F.col("l_linenumber").alias("line_number"), F.array(F.col("l_partkey").cast("string"), F.concat(F.lit("p-"), "l_partkey")).alias("part_keys"), F.lit("s").alias("segment_id"))
    held = F.struct("l_linenumber", "l_partkey", line.alias("line"))
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.array_sort(F.collect_list(held)), lambda x: x["line"]).alias("lines"))
    orders = read(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    body = F.struct(
        F.concat(F.lit("order-"), "o_orderkey").alias("report_id"), F.col("o_orderstatus").alias("order_status"), (F.col("o_orderstatus") == "O").alias("is_open"), F.lit(None).cast("string").alias("missing"),
        F.concat(F.lit("  first \r\n  "), "o_orderpriority", F.lit("\t\n")).alias("note"), F.lit(1).alias("segment_id"), F.coalesce("lines", F.array()).alias("lines"), F.struct(F.lit("z").alias("x_y")).alias("meta_data"),
    )
    made = orders.select("o_orderkey", markdown.normalize_document(F.to_json(body, {"ignoreNullFields": "false"}).cast("binary")).alias("r"))
    return made.select(
        F.col("o_orderkey").alias("order_key"), F.sha2("r.markdown", 256).alias("markdown_sha256"), F.col("r.canonicalHash").alias("canonical_hash"), F.col("r.segmentIds").alias("segment_ids"), F.col("r.topLevelEntries").alias("entries"),
        F.col("r.sanitizedEntries").alias("sanitized_entries"), F.col("r.lines").alias("lines"), F.col("r.businessDocumentKey").alias("business_key"),
    )


# chunks


def pack_sql(joiner: str, items: str, most: int = CHUNK) -> str:
    """A greedy fold in SQL: pieces joined while they fit."""
    return f"""list_reduce({items}, lambda s, x: case when s.now is null then {{'done': s.done, 'now': x.now}} when length(s.now) + {len(joiner)} + length(x.now) <= {most}
  then {{'done': s.done, 'now': s.now || '{joiner}' || x.now}} else {{'done': list_append(s.done, s.now), 'now': x.now}} end, {{'done': cast([] as varchar[]), 'now': cast(null as varchar)}})"""


#: White space of any script, and the ends of lines beside the newline, as DuckDB's patterns have them.
SPACE_SQL = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
LINE_END_SQL = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{SPACE_SQL}', ''), '{SPACE_SQL}$', '')"


def chunks_sql(texts: str) -> str:
    """(doc_id, content, chunk_index) of texts without blank lines: a text that is too long is one paragraph, its lines
    are packed and each packed chunk is stripped; a single line is cut."""
    lines = f"list_transform(regexp_split_to_array(t, '{LINE_END_SQL}'), lambda l: {{'done': cast([] as varchar[]), 'now': regexp_replace(l, '{SPACE_SQL}$', '')}})"
    fold = pack_sql("NL", lines).replace("'NL'", "chr(10)").replace("+ 2 +", "+ 1 +")
    cut = f"list_transform(range(0, cast(length(t) as bigint), {CHUNK}), lambda i: substr(t, i + 1, {CHUNK}))"
    return f"""with d as (select doc_id, {strip_sql("text")} as t from ({texts})),
p as (select doc_id, t, case when length(t) > {CHUNK} and regexp_matches(t, '{LINE_END_SQL}') then {fold} end as f from d),
l as (select doc_id, case when length(t) <= {CHUNK} then [t] else list_filter(list_transform(case when f is not null then list_append(f.done, f.now) else {cut} end, lambda x: {strip_sql("x")}), lambda x: x <> '') end as found from p),
c as (select doc_id, unnest(found) as content, generate_subscripts(found, 1) as chunk_index from l)
"""


CHUNKS_SQL = chunks_sql("select doc_id, text from (select * replace (coalesce(text, '') as text) from documents)")


def document_chunks(spark, sf_dir) -> DataFrame:
    return chunking.chunk_records(files(spark, sf_dir).select("doc_id", "text"), CHUNK, "doc_id", "text")


@query(CHUNKS_SQL + "select doc_id, cast(chunk_index as bigint) as chunk_index, cast(length(content) as bigint) as chars, sha256(content) as content_sha256 from c")
def chunks(spark, sf_dir):
    found = document_chunks(spark, sf_dir)
    return found.select("doc_id", F.col("chunkIndex").cast("long").alias("chunk_index"), F.length("content").cast("long").alias("chars"), F.sha2("content", 256).alias("content_sha256"))


#: Every comma ends a line with white space of three kinds behind it, and the next line is indented.
RAGGED = "\u00a0\x0b \n   \t"


@query(chunks_sql("select doc_id, replace(text, ', ', chr(160) || chr(11) || ' ' || chr(10) || '   ' || chr(9)) || chr(10) || chr(160) as text from (select * replace (coalesce(text, '') as text) from documents)") + "select doc_id, cast(chunk_index as bigint) as chunk_index, cast(length(content) as bigint) as chars, sha256(content) as content_sha256 from c")
def ragged_chunks(spark, sf_dir):
    """Indented lines with white space of every kind at their ends, as rendered documents have them."""
    docs = files(spark, sf_dir).select("doc_id", F.concat(F.replace("text", F.lit(", "), F.lit(RAGGED)), F.lit("\n\u00a0")).alias("text"))
    found = chunking.chunk_records(docs, CHUNK, "doc_id", "text")
    return found.select("doc_id", F.col("chunkIndex").cast("long").alias("chunk_index"), F.length("content").cast("long").alias("chars"), F.sha2("content", 256).alias("content_sha256"))


@query(f"""
with d as (select doc_id, replace(text, ', ', chr(160) || chr(9) || chr(13) || chr(10) || '  ') || ' ' || chr(13) as text from (select * replace (coalesce(text, '') as text) from documents)),
n as (select doc_id, {strip_sql("array_to_string(list_transform(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)), lambda l: regexp_replace(l, '" + SPACE_SQL + "$', '')), chr(10))")} as t from d)
select doc_id, sha256(t) as canonical_sha256, cast(case when t = '' then 0 else length(t) - length(replace(t, chr(10), '')) + 1 end as bigint) as lines from n""")
def normalized_texts(spark, sf_dir):
    """Newlines of three kinds and white space at line ends: the canonical text's hash and lines."""
    docs = files(spark, sf_dir).select("doc_id", F.concat(F.replace("text", F.lit(", "), F.lit("\u00a0\t\r\n  ")), F.lit(" \r")).alias("text"))
    made = docs.select("doc_id", text.normalized(F.col("text")).alias("t"))
    return made.select("doc_id", F.sha2("t", 256).alias("canonical_sha256"), text.line_count(F.col("t")).alias("lines"))


@query(CHUNKS_SQL + "select doc_id, count(*) as chunks, cast(sum(length(content)) as bigint) as chars, cast(max(length(content)) as bigint) as longest from c group by 1")
def chunk_counts(spark, sf_dir):
    n = F.length("content").cast("long")
    return document_chunks(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum(n).alias("chars"), F.max(n).alias("longest"))


@query(CHUNKS_SQL + "select doc_id, 'canonical/' || doc_id || '/chunk-' || format('{:04d}', chunk_index) || '.md' as content_key, 'canonical/' || doc_id || '/chunk-' || format('{:04d}', chunk_index) || '.md.metadata.json' as metadata_key, '{\"metadataAttributes\": {\"documentId\": \"' || doc_id || '\"}}' as metadata from c")
def chunk_keys(spark, sf_dir):
    return document_chunks(spark, sf_dir).select("doc_id", F.col("contentKey").alias("content_key"), F.col("metadataKey").alias("metadata_key"), "metadata")


@query(f"""
with d as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda l: trim(l, ' ' || chr(9))), lambda l: l <> '') as ps from (select * replace (coalesce(text, '') as text) from documents)),
q as (select doc_id, list_reduce(list_transform(ps, lambda l: case when length(l) <= {CHUNK} then {{'done': cast([] as varchar[]), 'now': l}}
  else {{'done': list_filter(list_transform(range(0, cast(length(l) as bigint), {CHUNK}), lambda i: trim(substr(l, i + 1, {CHUNK}))), lambda x: x <> ''), 'now': cast(null as varchar)}} end),
  lambda s, x: case when x.now is null then {{'done': list_concat(case when s.now is null then s.done else list_append(s.done, s.now) end, x.done), 'now': cast(null as varchar)}}
  when s.now is null then {{'done': s.done, 'now': x.now}} when length(s.now) + 2 + length(x.now) <= {CHUNK} then {{'done': s.done, 'now': s.now || chr(10) || chr(10) || x.now}}
  else {{'done': list_append(s.done, s.now), 'now': x.now}} end, {{'done': cast([] as varchar[]), 'now': cast(null as varchar)}}) as f, ps from d),
c as (select doc_id, case when len(ps) = 0 then [''] when f.now is null then f.done else list_append(f.done, f.now) end as found from q)
select doc_id, cast(len(c.found) as bigint) as chunks, sha256(array_to_string(c.found, '|')) as contents_sha256 from c""")
def paragraph_chunks_all(spark, sf_dir):
    """Texts whose lines are paragraphs, whole: long ones among short ones close the run and are cut; blank texts too."""
    docs = files(spark, sf_dir).select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("t"))
    found = docs.select("doc_id", text.chunks(F.col("t"), CHUNK).alias("c"))
    return found.select("doc_id", F.size("c").cast("long").alias("chunks"), F.sha2(F.array_join("c", "|"), 256).alias("contents_sha256"))


@query(CHUNKS_SQL + """, e as (select 'canonical/' || doc_id || '/chunk-' || format('{:04d}', chunk_index) || '.md' as k from c), a as (select k from e where right(k, 7) <> '0002.md'), m as (select k from e except select k from a)
select count(*) as missing, array_to_string(list_slice(list_sort(list(k)), 1, 10), ',') as first_missing from m""")
def chunk_persistence_check(spark, sf_dir):
    expected = document_chunks(spark, sf_dir).select(F.col("contentKey").alias("k"))
    gone = objects.missing_keys(expected, expected.where(~F.col("k").endswith("0002.md")), "k")
    first = gone.orderBy("k").limit(10).select("k", F.lit(True).alias("shown"))
    return gone.join(first, "k", "left").agg(F.count("*").alias("missing"), csv(F.array_sort(F.collect_list(F.when(F.col("shown"), F.col("k"))))).alias("first_missing"))


@query(VARIANTS + """, d as (select distinct 'doc-' || substr(canonical, 8, 16) as document, canonical from h), s as (select distinct source, 'doc-' || substr(canonical, 8, 16) as document from h)
select source as submission_id, canonical as canonical_hash, document as document_id from s join d using (document)""")
def documents_by_hash(spark, sf_dir):
    """Which document a submission has for a canonical hash: sources as submissions of their documents, null like any other."""
    made = dedupe.resolved(variants_at_rest(spark, sf_dir), empty_documents(spark), ("doc_id", "variant"))
    of = made.select(F.col("source").alias("submissionId"), "documentId").distinct()
    found = attach.with_hash(of, made.select("documentId", "canonicalHash").distinct())
    return found.select(F.col("submissionId").alias("submission_id"), F.col("canonicalHash").alias("canonical_hash"), F.col("documentId").alias("document_id"))


# versions


def candidates(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("businessDocumentKey"), F.col("doc_id").cast("string").alias("documentId"), F.concat(F.lit("v"), F.col("doc_id") % 13).alias("sourceVersion"), F.lit(None).cast("string").alias("sourceUpdatedAt"), F.col("doc_id").alias("seq"))


ACTIVE_SQL = "select source as business_key, arg_max(cast(doc_id as varchar), ('v' || (doc_id % 13), doc_id)) as active_document, count(*) as candidates from documents where source is not null group by 1"


@query(ACTIVE_SQL)
def active_version(spark, sf_dir):
    found = versions.elected_by_order(candidates(spark, sf_dir), "seq")
    return found.select(F.col("businessDocumentKey").alias("business_key"), F.col("activeDocumentId").alias("active_document"), "candidates")


@query(ACTIVE_SQL)
def active_version_fold(spark, sf_dir):
    found = versions.elected(candidates(spark, sf_dir), "seq")
    return found.select(F.col("businessDocumentKey").alias("business_key"), F.col("activeDocumentId").alias("active_document"), "candidates")


@query("""
select doc_id, source as business_key, max('v' || (doc_id % 13)) over (partition by source order by doc_id rows unbounded preceding) as active_version,
  ('v' || (doc_id % 13)) = max('v' || (doc_id % 13)) over (partition by source order by doc_id rows unbounded preceding) as took_over from documents""")
def activation_history(spark, sf_dir):
    found = ordered.running_max(candidates(spark, sf_dir), "businessDocumentKey", "seq", F.col("sourceVersion"), "active_version")
    return found.select(F.col("seq").alias("doc_id"), F.col("businessDocumentKey").alias("business_key"), "active_version", (F.col("sourceVersion") == F.col("active_version")).alias("took_over"))


#: Keys whose candidates have a version, a date or neither. Documents without a source are those of the key "none".
NULL_ORDERS = """with c as (select doc_id, coalesce(source, 'none') || '-' || (doc_id // 997 % 5) as k, 'd' || (doc_id % 17) as d,
  case when doc_id % 3 <> 1 then 'v' || (doc_id * 7 % 13) end as v, case when doc_id % 6 = 1 then '2026-' || (doc_id % 9) end as u from documents),
t as (select k, list({'d': d, 'o': case when v is not null then 'version ' || v when u is not null then 'updated_at ' || u end} order by doc_id) as turns from c group by k),
f as (select k, len(turns) as n, list_reduce(turns, lambda s, x: case when s.d = x.d or s.o is null or x.o is null or x.o >= s.o then x else s end) as won from t)
"""


def orders_with_nulls(spark, sf_dir) -> DataFrame:
    i = F.col("doc_id")
    return read(spark, sf_dir, "documents").select(
        F.concat(F.coalesce("source", F.lit("none")), F.lit("-"), F.floor(i / 997) % 5).alias("businessDocumentKey"), F.concat(F.lit("d"), i % 17).alias("documentId"),
        F.when(i % 3 != 1, F.concat(F.lit("v"), i * 7 % 13)).alias("sourceVersion"), F.when(i % 6 == 1, F.concat(F.lit("2026-"), i % 9)).alias("sourceUpdatedAt"), i.alias("seq"),
    )


ELECTION_SQL = "select k as business_key, won.d as active_document, cast(n as bigint) as candidates from f"


@query(NULL_ORDERS + ELECTION_SQL)
def election_without_orders(spark, sf_dir):
    """Elections in which some candidates have a date only, and some no order at all: every turn against the one before."""
    found = versions.elected(orders_with_nulls(spark, sf_dir), "seq")
    return found.select(F.col("businessDocumentKey").alias("business_key"), F.col("activeDocumentId").alias("active_document"), "candidates")


@query(NULL_ORDERS + ELECTION_SQL)
def election_in_stretches(spark, sf_dir):
    """The same, with each key's candidates spread over tasks, as those of a hot key are."""
    found = versions.elected(orders_with_nulls(spark, sf_dir), "seq", fold_rows=40, stretch_rows=1000)
    return found.select(F.col("businessDocumentKey").alias("business_key"), F.col("activeDocumentId").alias("active_document"), "candidates")


@query("with a as (select arg_max(doc_id, ('v' || (doc_id % 13), doc_id)) as w from documents where source = 'src3') select cast(doc_id as varchar) as document_id, 'v' || (doc_id % 13) as version, doc_id = w as is_active from documents, a where source = 'src3'")
def versions_of_key(spark, sf_dir):
    rows = versions.versions_of(candidates(spark, sf_dir), "src3")
    found = versions.flagged(rows, versions.elected_by_order(rows, "seq"))
    return found.select(F.col("documentId").alias("document_id"), F.col("sourceVersion").alias("version"), F.col("isActive").alias("is_active"))


# documents of submissions, index runs, readiness


@query("""
select o_orderkey as submission_id, coalesce(array_to_string(list_sort(list_distinct(list_concat(['p' || (o_orderkey % 9)], coalesce(l, [])))), ','), '') as document_ids, case when l is null then o_orderstatus else 'COMPLETE' end as status
from orders left join (select l_orderkey, list(distinct 'p' || (l_partkey % 50)) as l from lineitem group by 1) on l_orderkey = o_orderkey""")
def attach_documents(spark, sf_dir):
    subs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("submissionId"), F.col("o_orderstatus").alias("status"), F.array(F.concat(F.lit("p"), F.col("o_orderkey") % 9)).alias("documentIds"))
    files = deliveries(spark, sf_dir).select("submissionId", F.concat(F.lit("p"), F.col("l_partkey") % 50).alias("canonicalDocumentId"), F.lit("").alias("resolvedDocumentId"))
    found = attach.attached(subs, attach.document_of(files))
    return found.select(F.col("submissionId").alias("submission_id"), csv(F.col("documentIds")).alias("document_ids"), "status")


def labelled(spark, sf_dir) -> DataFrame:
    """documents as a registry: toxic ones failed, good ones are indexed, others and unlabelled ones pend."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    status = F.when(F.col("toxic") == 1, "FAILED").when(F.col("quality") == 1, "INDEXED").when(F.col("quality") == 0, "PENDING_INGESTION")
    return read(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left").select(F.col("doc_id").alias("documentId"), "source", status.alias("kbIngestionStatus"), F.col("doc_id").alias("createdAt"))


STATUS_SQL = "with s as (select d.doc_id, d.source, case when toxic = 1 then 'FAILED' when quality = 1 then 'INDEXED' when quality = 0 then 'PENDING_INGESTION' end as status from documents d left join labels l on d.doc_id = l.doc_id)\n"


@query(STATUS_SQL + "select doc_id, source from s where status = 'PENDING_INGESTION' order by doc_id limit 10")
def pending_batch(spark, sf_dir):
    return indexing.pending(labelled(spark, sf_dir)).select(F.col("documentId").alias("doc_id"), "source")


@query("""
with j as (select case o_orderstatus when 'F' then 'COMPLETE' when 'O' then 'IN_PROGRESS' when 'P' then 'STOPPED' else o_orderstatus end as job, o_orderkey % 3 as failed, case when o_orderkey % 7 = 0 then ['disk', 'net ' || (o_orderkey % 2)] else [] end as reasons from orders),
r as (select case when job in ('STARTING', 'IN_PROGRESS', 'STOPPING') then 'STARTED' when job = 'COMPLETE' and failed = 0 and len(reasons) = 0 then 'SUCCEEDED' else 'FAILED' end as run_status, nullif(left(array_to_string(reasons, ' | '), 2048), '') as error_summary from j)
select run_status, case run_status when 'SUCCEEDED' then 'INDEXED' when 'FAILED' then 'FAILED' else 'INGESTING' end as document_status, error_summary, count(*) as n from r group by all""")
def job_status_map(spark, sf_dir):
    o, key = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    job = F.when(F.col("o_orderstatus") == "F", "COMPLETE").when(F.col("o_orderstatus") == "O", "IN_PROGRESS").when(F.col("o_orderstatus") == "P", "STOPPED").otherwise(F.col("o_orderstatus"))
    jobs = o.select(job.alias("job"), (key % 3).alias("failed"), F.when(key % 7 == 0, F.array(F.lit("disk"), F.concat(F.lit("net "), key % 2))).otherwise(F.array().cast("array<string>")).alias("reasons"))
    runs = jobs.select(indexing.run_status(F.col("job"), indexing.has_failures(F.col("failed"), F.col("reasons"))).alias("run_status"), indexing.error_summary(F.col("reasons")).alias("error_summary"))
    return runs.groupBy("run_status", indexing.document_status(F.col("run_status")).alias("document_status"), "error_summary").agg(F.count("*").alias("n"))


@query("""
with x as (select distinct l_orderkey as d, l_partkey as run from lineitem), f as (select d, max(run) as run from x group by 1),
s as (select d, case run % 3 when 0 then 'SUCCEEDED' when 1 then 'FAILED' else 'STARTED' end as status from f)
select status as run_status, case status when 'SUCCEEDED' then 'INDEXED' when 'FAILED' then 'FAILED' when 'STARTED' then 'INGESTING' else 'PENDING_INGESTION' end as document_status, count(*) as documents
from orders left join s on d = o_orderkey group by 1, 2""")
def run_fanout_all(spark, sf_dir):
    return run_outcomes(spark, sf_dir, read(spark, sf_dir, "lineitem"))


def run_outcomes(spark, sf_dir, rows: DataFrame) -> DataFrame:
    last = rows.groupBy("l_orderkey").agg(F.max("l_partkey").alias("run"))  # a document is in one run at a time
    status = F.when(F.col("run") % 3 == 0, "SUCCEEDED").when(F.col("run") % 3 == 1, "FAILED").otherwise("STARTED")
    runs = last.groupBy("run").agg(F.collect_list("l_orderkey").alias("documentIds")).select(F.concat(F.lit("run-"), "run").alias("ingestionRunId"), status.alias("status"), "documentIds", F.lit(None).cast("string").alias("errorSummary"))
    none = {c: F.lit(None).cast("string") for c in ("pendingIngestionRunId", "lastSuccessfulIngestionRunId", "lastIngestionError")}
    docs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("documentId"), F.lit("PENDING_INGESTION").alias("kbIngestionStatus")).withColumns(none)
    found = indexing.fanned_out(docs, runs)
    run = F.when(F.col("kbIngestionStatus") == "INDEXED", "SUCCEEDED").when(F.col("kbIngestionStatus") == "FAILED", "FAILED").when(F.col("kbIngestionStatus") == "INGESTING", "STARTED")
    return found.groupBy(run.alias("run_status"), F.col("kbIngestionStatus").alias("document_status")).agg(F.count("*").alias("documents"))


def submission_states(spark, sf_dir) -> DataFrame:
    """Sources as submissions of their documents."""
    return labelled(spark, sf_dir).select(F.concat("source", F.lit("-"), F.col("documentId") % 7).alias("submissionId"), "documentId", F.col("kbIngestionStatus").alias("status"))


@query(STATUS_SQL + """, g as (select source || '-' || (doc_id % 7) as submission_id, count(*) filter (where status = 'INDEXED') as indexed, count(*) filter (where status = 'FAILED') as failed, count(*) filter (where status is null or status not in ('INDEXED', 'FAILED')) as pending from s group by 1)
select submission_id, case when failed > 0 then 'FAILED' when pending = 0 then 'READY' else 'WAITING_FOR_INDEX' end as status, indexed, failed, pending from g""")
def readiness(spark, sf_dir):
    found = ready_ops.readiness(submission_states(spark, sf_dir))
    return found.select(F.col("submissionId").alias("submission_id"), "status", "indexed", "failed", "pending")


@query(STATUS_SQL + "select source || '-' || (doc_id % 7) as submission_id, string_agg(doc_id || '=' || coalesce(status, 'MISSING'), ',' order by doc_id) as documents from s group by 1")
def document_state_summary(spark, sf_dir):
    found = ready_ops.summaries(submission_states(spark, sf_dir))
    return found.select(F.col("submissionId").alias("submission_id"), csv(F.transform("documents", lambda x: F.concat(x["documentId"], F.lit("="), x["status"]))).alias("documents"))


# monitoring

NOW_SQL = f"timestamp '{NOW}'"
STATUS_OF_EVENT = {"click": "RECEIVING", "view": "COMPLETE", "purchase": "WAITING_FOR_INDEX", "error": "FAILED"}
EVENT_STATUS_SQL = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in STATUS_OF_EVENT.items()) + " else 'READY' end"


def updates(spark, sf_dir) -> DataFrame:
    """events as rows of registries."""
    status = F.lit("READY")
    for kind, said in STATUS_OF_EVENT.items():
        status = F.when(F.col("event_type") == kind, said).otherwise(status)
    rows = read(spark, sf_dir, "events")
    return rows.select("event_id", "event_type", "user_id", "value", F.col("ts").alias("updatedAt"), status.alias("status"), F.when(F.col("event_type") == "error", "FAILED").alias("callbackStatus"), F.when(F.col("event_type") == "click", "INGESTING").otherwise("INDEXED").alias("kbIngestionStatus"))


@query("select coalesce(o_orderstatus, 'UNKNOWN') as status, count(*) as n from orders group by 1")
def status_counts(spark, sf_dir):
    return monitor.count_by_status(read(spark, sf_dir, "orders"), "o_orderstatus")


AGE_SQL = f"(epoch_us({NOW_SQL}) - epoch_us(ts)) / 60000000.0"


@query(f"select event_id, {EVENT_STATUS_SQL} as status, cast(floor({AGE_SQL}) as bigint) as minutes from events where {EVENT_STATUS_SQL} in ('RECEIVING', 'COMPLETE', 'WAITING_FOR_INDEX') and coalesce({AGE_SQL}, 0) >= 15")
def stale_submissions(spark, sf_dir):
    return monitor.stale_submissions(updates(spark, sf_dir), now()).select("event_id", "status", F.floor(times.minutes_since(F.col("updatedAt"), now())).alias("minutes"))


@query(f"select event_id, user_id from events where event_type = 'click' and coalesce({AGE_SQL}, 0) >= 15")
def stuck_documents(spark, sf_dir):
    return monitor.stuck_documents(updates(spark, sf_dir), now()).select("event_id", "user_id")


@query("select event_id, user_id from events where event_type = 'error'")
def callback_failures(spark, sf_dir):
    return monitor.callback_failures(updates(spark, sf_dir)).select("event_id", "user_id")


@query(f"""
select 'submission_stuck_non_terminal' as alert_type, event_id, {EVENT_STATUS_SQL} as status, cast(null as bigint) as user_id from events where {EVENT_STATUS_SQL} in ('RECEIVING', 'COMPLETE', 'WAITING_FOR_INDEX') and coalesce({AGE_SQL}, 0) >= 15
union all select 'document_stuck_ingesting', event_id, null, user_id from events where event_type = 'click' and coalesce({AGE_SQL}, 0) >= 15
union all select 'callback_failed', event_id, {EVENT_STATUS_SQL}, user_id from events where event_type = 'error'""")
def manual_review_union(spark, sf_dir):
    rows = updates(spark, sf_dir)
    found = monitor.alerts(
        submission_stuck_non_terminal=monitor.stale_submissions(rows, now()).select("event_id", "status"),
        document_stuck_ingesting=monitor.stuck_documents(rows, now()).select("event_id", "user_id"),
        callback_failed=monitor.callback_failures(rows).select("event_id", "status", "user_id"),
    )
    return found.select(F.col("alertType").alias("alert_type"), "event_id", "status", "user_id")


REVIEW_SQL = f"""with m as (select event_id as id, coalesce(event_type, 'UNKNOWN') as kind, ts from events),
r as (select id, count(*) as n, max(ts + to_minutes(cast(k * (id % 4) as integer))) as last, bool_or(k = 3 and id % 7 = 0) as deleted from m, (select unnest(range(1, 7)) as k) where k <= id % 7 group by id),
q as (select m.*, coalesce(n, 0) as n, case when deleted then 'DELETED' when ts + interval 14 days <= {NOW_SQL} then 'EXPIRED' when last + interval 60 seconds > {NOW_SQL} then 'IN_FLIGHT' when coalesce(n, 0) >= 5 then 'DEAD' else 'WAITING' end as state from m left join r using (id))
"""


def review_queue(spark, sf_dir) -> DataFrame:
    """events as review messages that were received up to six times each; one without a type is of the type UNKNOWN."""
    rows = read(spark, sf_dir, "events").select(F.col("event_id").alias("messageId"), F.coalesce("event_type", F.lit("UNKNOWN")).alias("alertType"), F.col("ts").alias("sentAt"))
    turns = rows.select("messageId", "sentAt", F.explode(F.sequence(F.lit(0), (F.col("messageId") % 7).cast("int"))).alias("k")).where("k > 0")
    received = turns.select("messageId", (F.col("sentAt") + F.make_dt_interval(mins=(F.col("k") * (F.col("messageId") % 4)).cast("int"))).alias("receivedAt"), ((F.col("k") == 3) & (F.col("messageId") % 7 == 0)).alias("deleted"))
    return review.with_receives(rows, received, now())


@query(REVIEW_SQL + "select kind as alert_type, state, count(*) as messages, cast(sum(n) as bigint) as receives from q group by 1, 2")
def review_states(spark, sf_dir):
    found = review_queue(spark, sf_dir).groupBy(F.col("alertType").alias("alert_type"), "state")
    return found.agg(F.count("*").alias("messages"), F.sum("receiveCount").alias("receives"))


@query(REVIEW_SQL + ", h as (select kind, arg_min(id, (ts, id)) as id, arg_min(state, (ts, id)) as state, arg_min(n, (ts, id)) as n from q where state in ('WAITING', 'IN_FLIGHT') group by 1) select kind as alert_type, id as message_id, cast(n as bigint) as receives from h where state = 'WAITING'")
def review_next(spark, sf_dir):
    found = review.receivable(review_queue(spark, sf_dir))
    return found.select(F.col("alertType").alias("alert_type"), F.col("messageId").alias("message_id"), F.col("receiveCount").alias("receives"))


@query("""with recursive m as (select event_type, coalesce(cast(user_id as varchar), '') as content, ts, min(event_id) as id from events where ts is not null group by 1, 2, 3),
kept as (select event_type, content, min(ts) as ts from m group by 1, 2
  union all select k.event_type, k.content, min(m.ts) from kept k join m on m.event_type is not distinct from k.event_type and m.content = k.content and m.ts >= k.ts + interval 5 minutes group by 1, 2)
select m.event_type as alert_type, m.id as message_id from m join kept k on m.event_type is not distinct from k.event_type and m.content = k.content and m.ts = k.ts""")
def review_accepted(spark, sf_dir):
    """An accepted message silences equal contents of its group for five minutes from itself."""
    rows = read(spark, sf_dir, "events").select(F.col("event_id").alias("messageId"), F.col("event_type").alias("alertType"), F.col("ts").alias("sentAt"), "user_id")
    return review.accepted(rows, F.coalesce(F.col("user_id").cast("string"), F.lit(""))).select(F.col("alertType").alias("alert_type"), F.col("messageId").alias("message_id"))


@query("""with recursive m as (select event_type, ts, min(event_id) as id from events where ts is not null group by 1, 2),
kept as (select event_type, min(ts) as ts from m group by 1
  union all select k.event_type, min(m.ts) from kept k join m on m.event_type is not distinct from k.event_type and m.ts >= k.ts + interval 5 minutes group by 1)
select m.event_type as alert_type, m.id as message_id from m join kept k on m.event_type is not distinct from k.event_type and m.ts = k.ts""")
def review_accepted_hot(spark, sf_dir):
    """The same where each group has one content alone: hot contents are cut into stretches of time."""
    rows = read(spark, sf_dir, "events").select(F.col("event_id").alias("messageId"), F.col("event_type").alias("alertType"), F.col("ts").alias("sentAt"))
    return review.accepted(rows, F.lit(""), stretch=512).select(F.col("alertType").alias("alert_type"), F.col("messageId").alias("message_id"))


METRICS_SQL = f"""with e as (select *, {EVENT_STATUS_SQL} as status, {AGE_SQL} as age from events),
a as (select count(*) filter (where status in ('RECEIVING', 'COMPLETE', 'WAITING_FOR_INDEX') and coalesce(age, 0) >= 15) as stale, count(*) filter (where event_type = 'click' and coalesce(age, 0) >= 15) as stuck, count(*) filter (where event_type = 'error') as failed from e)
select 'SubmissionCount' as name, status, cast(count(*) as double) as value from e group by 2 union all select 'IngestionRunCount', coalesce(o_orderstatus, 'UNKNOWN'), cast(count(*) as double) from orders group by 2
union all select 'DocumentsStuckInIngesting', null, cast(stuck as double) from a union all select 'SubmissionsStuckNonTerminal', null, cast(stale as double) from a
union all select 'CallbackFailureCount', null, cast(failed as double) from a union all select 'ManualReviewItemsQueued', null, cast(stale + stuck + failed as double) from a"""


@query(METRICS_SQL)
def monitor_metrics(spark, sf_dir):
    """One pass of the monitor: events as submissions and documents, orders as index runs."""
    rows = updates(spark, sf_dir).withColumns({"submissionId": F.col("event_id").cast("string"), "documentId": F.col("event_id").cast("string"), "documentIds": F.array().cast("array<string>")})
    none = {c: F.lit(None).cast("string") for c in ("pendingIngestionRunId", "canonicalHash", "callbackFailureReason")}
    rows = rows.withColumns(none)
    found = monitor.submission_alerts(rows, rows, now(), "dev")
    runs = read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"))
    return monitor.metrics(rows, runs, found, "dev", now()).select("name", F.col("dimensions")["Status"].alias("status"), "value")


@query("select event_type, event_id, cast((row_number() over (partition by event_type order by event_id) - 1) // 20 as bigint) as batch from events")
def metric_batches(spark, sf_dir):
    return monitor.grouped_batches(read(spark, sf_dir, "events"), "event_type", "event_id").select("event_type", "event_id", "batch")


@query("select event_type as name, epoch(time_bucket(interval '5 minutes', ts)) as bucket, count(*) as occurrences, count(*) >= 2 as in_alarm from events group by 1, 2")
def alarms_5m(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.col("event_type").alias("name"), F.col("ts").cast("timestamp").alias("ts"), F.lit(1).cast("long").alias("value"))
    found = monitor.alarms(rows, threshold=2)
    return found.select("name", F.unix_timestamp("bucket").cast("double").alias("bucket"), F.col("value").alias("occurrences"), F.col("inAlarm").alias("in_alarm"))


@query("select epoch(time_bucket(interval '5 minutes', ts)) as bucket, " + ", ".join(f"coalesce(max(value) filter (where event_type = '{k}'), 0.0) as {k}" for k in ("click", "error", "purchase", "view")) + " from events group by 1")
def dashboard_series(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.col("event_type").alias("status"), F.col("ts").cast("timestamp").alias("ts"), "value")
    kinds = ["click", "error", "purchase", "view"]
    return monitor.dashboard(rows, kinds).select(F.unix_timestamp("bucket").cast("double").alias("bucket"), *kinds)


@query(f"select event_id from events where ts >= {NOW_SQL} - case event_id % 3 when 0 then interval 14 days when 1 then interval 3 days else interval 1000 days end")
def lifecycle_expiry(spark, sf_dir):
    prefix = F.when(F.col("event_id") % 3 == 0, "ingestion/").when(F.col("event_id") % 3 == 1, "processed/").otherwise("canonical/")
    rows = read(spark, sf_dir, "events").select("event_id", "ts", F.concat(prefix, F.col("event_id").cast("string")).alias("key"))
    return objects.live(rows, "key", "ts", now()).select("event_id")


@query("select user_id, event_type as status, event_id as seq, value from (select *, row_number() over (partition by user_id order by event_id desc) as k from events) where k = 1")
def latest_state(spark, sf_dir):
    log = read(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("status"), F.col("event_id").alias("seq"), "value")
    return registry.latest_state(log, "user_id", "seq").select("user_id", "status", "seq", "value")


@query("select user_id, min(event_id) as event_id from events where user_id % 3 <> 0 group by 1")
def insert_if_absent(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("user_id", "event_id")
    known = rows.where("user_id % 3 = 0").select("user_id").distinct()
    return registry.insert_if_absent(rows, known, "user_id", F.col("event_id"))[0]


# retrieval

COSINE_SQL = "list_cosine_similarity(cast(e.embedding as double[]), cast(q.embedding as double[]))"
TOPK_SQL = f"from embeddings e, (select embedding from embeddings where vec_id = 0) q where e.label in (1, 3, 5) order by {COSINE_SQL} desc, e.vec_id limit 10"


def indexed_chunks(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("label").alias("documentId"), F.col("vec_id").alias("chunkIndex"), "embedding")


def top_chunks(spark, sf_dir) -> DataFrame:
    rows = indexed_chunks(spark, sf_dir)
    probe = rows.where("chunkIndex = 0").first()
    scope = spark.createDataFrame([(1,), (3,), (5,)], "documentId int")
    return retrieval.nearest(retrieval.scoped(rows, scope, 3), probe["embedding"] if probe else [0.0], 50, ties=("chunkIndex",))


@query(f"select e.vec_id, e.label, round({COSINE_SQL}, 6) as score {TOPK_SQL}")
def scoped_topk(spark, sf_dir):
    return top_chunks(spark, sf_dir).select(F.col("chunkIndex").alias("vec_id"), F.col("documentId").alias("label"), F.round("score", 6).alias("score"))


@query(f"select array_to_string(list_sort(list(distinct cast(label as varchar))), ',') as document_ids, count(*) as results from (select e.label, e.vec_id {TOPK_SQL})")
def retrieved_ids(spark, sf_dir):
    found = top_chunks(spark, sf_dir).select(F.col("documentId").cast("string").alias("documentId"))
    return found.agg(csv(retrieval.document_ids(found)).alias("document_ids"), F.count("*").alias("results"))


@query(f"select count(*) filter (where label not in (1, 3, 5)) as leaked, count(*) filter (where label in (2, 4)) as foreign_hits from (select e.label, e.vec_id {TOPK_SQL})")
def scope_leak_check(spark, sf_dir):
    found = top_chunks(spark, sf_dir).select("documentId")
    own, other = (spark.createDataFrame([(i,) for i in ids], "documentId int") for ids in ((1, 3, 5), (2, 4)))
    kinds = retrieval.leaks(found, own).select(F.lit("leaked").alias("kind")).unionByName(found.join(other, "documentId", "left_semi").select(F.lit("foreign").alias("kind")))
    return kinds.agg(F.count_if(F.col("kind") == "leaked").alias("leaked"), F.count_if(F.col("kind") == "foreign").alias("foreign_hits"))


@query(f"""select case when count(*) = 0 then 'Summary placeholder: no scoped matches were found for submission s1 for query ''near 0''.'
  else 'Summary placeholder: retrieved ' || count(*) || ' scoped chunks for submission s1 for query ''near 0''.' end as summary from (select e.vec_id {TOPK_SQL})""")
def placeholder_summary(spark, sf_dir):
    n = top_chunks(spark, sf_dir).agg(F.count("*").alias("n"))
    return n.select(retrieval.placeholder_text(F.col("n"), F.lit("s1"), F.lit("near 0")).alias("summary"))


@query("select doc_id, left(text, 1200) as text, 'TEXT' as content_type from documents")
def snippets(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("documentId"), "doc_id", F.lit(0.0).alias("score"), F.col("text").alias("content"), F.lit("").alias("contentKey"))
    return retrieval.projected(rows).select(F.col("documentId").cast("long").alias("doc_id"), "text", F.col("contentType").alias("content_type"))


@query("""
with n as (select coalesce(source, 'none') as source, doc_id, coalesce(left(text, 1200), '') as t, row_number() over (partition by coalesce(source, 'none') order by doc_id) as k from documents),
r as (select source, string_agg('Result ' || k || chr(10) || 'documentId: ' || doc_id || chr(10) || 's3Uri: canonical/' || doc_id || '/chunk-0001.md' || chr(10) || 'score: 0.5' || chr(10) || t, chr(10) || chr(10) order by k) as results from n where k <= 4 group by 1)
select source, 'You are answering with only the provided scoped retrieval results.' || chr(10) || chr(10) || 'Submission ID: ' || source || chr(10) || chr(10) || 'User query: what is in it' || chr(10) || chr(10)
  || 'Provide a short answer grounded only in these snippets. If the answer is not present, say so plainly.' || chr(10) || chr(10) || '' || chr(10) || chr(10) || results as prompt from r""")
def prompt_context(spark, sf_dir):
    """The prompt over each source's first documents (null: the source "none"); each task keeps only those of its own rows."""
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy(F.coalesce("source", F.lit("none"))).orderBy("doc_id"))
    rows = read(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("none")).alias("source"), "doc_id", F.coalesce(F.left("text", F.lit(retrieval.SNIPPET_CHARS)), F.lit("")).alias("text"), place.alias("k"))
    kept = rows.where(F.col("k") <= retrieval.CONTEXT_SNIPPETS).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("k", "doc_id", "text"))).alias("all"))
    results = F.transform("all", lambda x: F.struct(x["doc_id"].cast("string").alias("documentId"), keys.chunk_key(x["doc_id"].cast("string"), F.lit(1)).alias("s3Uri"), F.lit("0.5").alias("score"), x["text"].alias("text")))
    return kept.select("source", retrieval.prompt_text(F.col("source"), F.lit("what is in it"), results).alias("prompt"))


@query("select cast(r.vec_id as bigint) as query_id, e.vec_id, round(list_cosine_similarity(cast(e.embedding as double[]), cast(r.embedding as double[])), 6) as score from embeddings e, embeddings r where r.vec_id % 100 = 0 and e.label = r.label and e.vec_id <> r.vec_id")
def scored_pairs_all(spark, sf_dir):
    """Chunks scored against every query of their own scope."""
    return pairs_of_scopes(spark, sf_dir, F.col("vec_id") % 100 == 0)


def pairs_of_scopes(spark, sf_dir, chosen: Column) -> DataFrame:
    """A scope's chunks are dealt over SALTS tasks; each gets the scope's queries."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    asked = rows.where(chosen).select(F.col("vec_id").alias("query_id"), "label", F.col("embedding").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    both = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")).join(asked, ["label", "salt"]).where("vec_id <> query_id")
    return both.select("query_id", "vec_id", F.round(retrieval.cosine(F.col("embedding"), F.col("q")), 6).alias("score"))


# streaming


@query("select user_id as submission_id, event_type as file_id, min(event_id) as first_event, count(*) as deliveries from events group by 1, 2")
def stream_receipts(spark, sf_dir):
    """The events table read as a stream to its end, batch by batch; the batches' logs give the registry."""
    import uuid

    folder = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    stream = streams.table_stream(spark, f"{sf_dir}/events.parquet")
    rows = stream.select(F.col("user_id").alias("submissionId"), F.col("event_type").alias("fileId"), "event_id")

    def each(batch: DataFrame, batch_id: int) -> None:  # by batch id: a batch that is run again writes the same folder
        receipts.first_receipts(batch, ("event_id",)).write.mode("overwrite").parquet(f"{folder}/log/batch={batch_id}")

    streams.drain(rows, each, f"{folder}/state")
    log = spark.read.parquet(f"{folder}/log")
    return log.groupBy(F.col("submissionId").alias("submission_id"), F.col("fileId").alias("file_id")).agg(F.min("arrived.event_id").alias("first_event"), F.sum("deliveries").alias("deliveries"))


#: Events as metrics: occurrences of two kinds are summed up, the values of two others' are watched for their maximum.
EVENT_ALARMS = (alarms.Alarm("many clicks", "click", "Sum", 3), alarms.Alarm("any error", "error", "Sum"), alarms.Alarm("large view", "view", "Maximum", 60), alarms.Alarm("large purchase", "purchase", "Maximum", 90))
ALARM_SQL = """with p as (select event_type as t, time_bucket(interval '5 minutes', ts) + interval '5 minutes' as e, count(*) as n, max(value) as most from events where ts is not null and value is not null group by 1, 2),
b as (select case t when 'click' then 'many clicks' when 'error' then 'any error' when 'view' then 'large view' when 'purchase' then 'large purchase' end as alarm, e from p
  where (t = 'click' and n >= 3) or (t = 'error' and n >= 1) or (t = 'view' and most >= 60) or (t = 'purchase' and most >= 90)),
x as (select alarm, e, 'OK' as from_state, 'ALARM' as to_state from b where not exists (select 1 from b c where c.alarm = b.alarm and c.e = b.e - interval '5 minutes')
  union all select alarm, e + interval '5 minutes', 'ALARM', 'OK' from b where not exists (select 1 from b c where c.alarm = b.alarm and c.e = b.e + interval '5 minutes'))
select alarm, epoch(e) as at, from_state, to_state from x where e < (select date_trunc('millisecond', max(ts)) from events)"""


def event_metrics(rows: DataFrame) -> DataFrame:
    counted = F.when(F.col("event_type").isin("click", "error"), F.when(F.col("value").isNotNull(), 1.0)).otherwise(F.col("value"))
    return rows.select(F.col("event_type").alias("name"), F.col("ts").cast("timestamp").alias("ts"), counted.alias("value"))


def shown_transitions(found: DataFrame) -> DataFrame:
    return found.select("alarm", F.unix_timestamp("at").cast("double").alias("at"), F.col("fromState").alias("from_state"), F.col("toState").alias("to_state"))


@query(ALARM_SQL)
def alarm_states(spark, sf_dir):
    """Transitions of alarms over the whole table at once."""
    rows = event_metrics(read(spark, sf_dir, "events"))
    newest = rows.agg(F.date_trunc("millisecond", F.max("ts")).alias("ts")).first()["ts"]
    return shown_transitions(alarms.transitions(rows, F.lit(newest).cast("timestamp"), EVENT_ALARMS))


@query(ALARM_SQL)
def stream_alarm_states(spark, sf_dir):
    """The same with the table as a stream: open periods and timers in a state store."""
    import uuid

    folder = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    found = alarms.transition_stream(event_metrics(streams.table_stream(spark, f"{sf_dir}/events.parquet")), EVENT_ALARMS)
    streams.drain(found, lambda batch, i: batch.write.mode("overwrite").parquet(f"{folder}/log/batch={i}"), f"{folder}/state")
    return shown_transitions(spark.read.schema(alarms.TRANSITION).parquet(f"{folder}/log"))


# the workflow


@query("""
with f as (select r_name as s, n_name as id from nation join region on n_regionkey = r_regionkey union all select r_name, 'world' from region)
select s as submission_id, 'READY' as status, 'DELIVERED' as callback_status, count(*) as files, count(*) as documents, least(count(*), 5) as retrieved, cast(0 as bigint) as foreign_documents,
  'Summary placeholder: retrieved ' || least(count(*), 5) || ' scoped chunks for submission ' || s || ' for query ' || chr(39) || 'about ' || s || chr(39) || '.' as summary, 'World' as shared_title,
  (select count(*) from nation) + 1 as all_documents, cast(1 as bigint) as shared_raw_files from f group by s""")
def workflow(spark, sf_dir):
    """Every region as a submission of its nations' files and one file that all share, from upload events to answers.

    Equal bytes are processed once; every document is indexed, every submission becomes READY and is called back, and
    retrieval stays in its scope.
    """
    import json
    import uuid

    from .engine import Engine

    regions = {r["r_regionkey"]: r["r_name"] for r in read(spark, sf_dir, "region").collect()}
    files = {name: {"world.json": {"report_id": "world", "title": "World", "source_version": "v1"}} for name in regions.values()}
    for r in read(spark, sf_dir, "nation").where("n_regionkey is not null").collect():
        if r["n_regionkey"] in regions:
            title = f"about {regions[r['n_regionkey']]}"
            files[regions[r["n_regionkey"]]][f"{r['n_name']}.json"] = {"report_id": r["n_name"], "title": title, "segments": [{"segment_id": 1, "name": r["n_name"]}]}
    root = f"{checkpoint_folder(spark)}/workflow-{uuid.uuid4().hex}"
    engine = Engine(spark, root)
    uploads = [f"ingestion/{s}/{name}" for s, held in files.items() for name in held]
    for s, held in files.items():
        for name, body in held.items():
            objects.put(spark, f"{root}/ingestion/{s}/{name}", json.dumps(body).encode())
    record = lambda key, i: {"eventName": "ObjectCreated:Put", "s3": {"bucket": {"name": "b"}, "object": {"key": key, "sequencer": f"{i:08d}"}}}
    engine.receive(spark.createDataFrame([([record(k, i) for i, k in enumerate([*uploads, uploads[0], "other/key"])],)], UPLOAD_EVENT))
    engine.complete_many(spark.createDataFrame([(s, sorted(held)) for s, held in files.items()], "submissionId string, expectedFileIds array<string>"))
    while engine.coordinate(batch=1000) == "SUCCEEDED":
        pass
    engine.refresh()
    documents, states = engine.state("documents"), {r["submissionId"]: r for r in engine.state("submissions").collect()}
    world = documents.where("businessDocumentKey = 'world'").select("documentId")
    counts = documents.count(), engine.state("raw_files").where("status = 'RESOLVED'").join(world, "documentId").count()
    rows = []
    for s in files:
        said, state = engine.query(s, f" about {s} "), states[s]
        foreign = len(set(said["retrievedDocumentIds"]) - set(state["documentIds"]))
        title = next((r["text"].split("Title: ")[1].split("\n")[0] for r in engine.query(s, "World")["retrievalResults"]), None)
        rows.append((s, state["status"], state["callbackStatus"], state["receivedFileCount"], len(state["documentIds"]), len(said["retrievalResults"]), foreign, said["summary"], title, *counts))
    return spark.createDataFrame(rows, "submission_id string, status string, callback_status string, files long, documents long, retrieved long, foreign_documents long, summary string, shared_title string, all_documents long, shared_raw_files long")


# submissions by the thousand

#: Orders as submissions of their lines' files. Every part and line number modulo three has a text, in two spellings; one part's is broken.
BATCH_SQL = """with f as (select l_orderkey as o, l_linenumber as n, min(l_partkey) % 97 as c from lineitem group by 1, 2),
r as (select o, bool_or(c = 5) as broken, count(distinct case when c <> 5 then c * 3 + n % 3 end) as documents from f group by o),
v as (select o_orderkey as o, case when r.o is null then 'SUBMISSION_NOT_FOUND' when o_orderkey % 5 = 0 then 'MISSING_FILES' when broken then 'FILES_UNRESOLVED' else 'OK' end as reason, r.documents from orders left join r on r.o = o_orderkey),
g as (select f.*, c * 3 + n % 3 as doc, c = 5 as broken, 'part-' || c as business_key, 'v' || (n % 3) as version from f join v using (o) where v.reason in ('OK', 'FILES_UNRESOLVED'))
"""
BATCH_HASH_SQL = """sha256('{"markdownText":"Report Id: ' || business_key || '\\n\\nSource Version: ' || version || '","normalizationStrategy":"json_to_markdown_lines_v2"}')"""


def batch_engine(spark, sf_dir):
    """(engine, verdicts) after one completion of all orders at once."""
    import uuid

    from .engine import Engine

    lines = read(spark, sf_dir, "lineitem").where("l_orderkey is not null and l_linenumber is not null")
    engine = Engine(spark, f"{checkpoint_folder(spark)}/batch-{uuid.uuid4().hex}")
    files_at = f"{engine.root}/files"  # the files are made once; requests and contents are read from there
    lines.groupBy("l_orderkey", "l_linenumber").agg((F.min("l_partkey") % 97).alias("c")).write.option("compression", "zstd").parquet(files_at)
    first = spark.read.parquet(files_at)
    version, blank = F.col("l_linenumber") % 3, F.when(F.col("l_orderkey") % 2 == 0, " ").otherwise("")
    pruned = F.when(version == 1, F.lit(', "segment_id": 1')).otherwise("")
    body = F.concat(F.lit('{"report_id": "part-'), "c", F.lit('", "source_version":'), blank, F.lit('"v'), version, F.lit('"'), pruned, F.lit("}"))
    submission, file = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    content = F.when(F.col("c") == 5, F.lit("{broken")).otherwise(body).cast("binary")
    raw = first.select(submission.alias("submissionId"), file.alias("fileId"), keys.raw_key(submission, file).alias("key"), content.alias("content"))
    event = F.struct(F.lit("ObjectCreated:Put").alias("eventName"), F.struct(F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct(keys.raw_key(submission, file).alias("key"), F.lit("0").alias("sequencer")).alias("object")).alias("s3"))
    engine.receive(lines.select(F.array(event).alias("Records")))
    own = first.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(file)).alias("files"))
    late = F.when(F.col("o_orderkey") % 5 == 0, F.array(F.lit("late"))).otherwise(F.array().cast("array<string>"))
    expected = F.concat(F.coalesce("files", F.array(F.lit("1"))), late)
    requests = read(spark, sf_dir, "orders").join(own, "o_orderkey", "left").select(F.col("o_orderkey").cast("string").alias("submissionId"), expected.alias("expectedFileIds"), F.col("o_orderkey").alias("turn"))
    return engine, engine.complete_many(requests, raw=raw)


@query(BATCH_SQL + """select o as submission_id, reason, reason = 'OK' as is_valid, case reason when 'OK' then 'COMPLETE' when 'SUBMISSION_NOT_FOUND' then null else 'RECEIVING' end as status,
  cast(case when reason = 'OK' then documents when reason = 'SUBMISSION_NOT_FOUND' then null else 0 end as bigint) as documents from v""")
def submissions_batch(spark, sf_dir):
    """All orders as submissions, completed at once: shared contents are rendered once, one broken file fails its submission alone."""
    engine, verdicts = batch_engine(spark, sf_dir)
    states = engine.state("submissions", columns=("status", "documentIds")).select("submissionId", "status", F.size(F.coalesce("documentIds", F.array().cast("array<string>"))).cast("long").alias("documents"))
    return verdicts.join(states, "submissionId", "left").select(F.col("submissionId").cast("long").alias("submission_id"), "reason", F.col("isValid").alias("is_valid"), "status", "documents")


@query(BATCH_SQL + f"""select 'doc-' || substr({BATCH_HASH_SQL}, 1, 16) as document_id, business_key, version as source_version, version = max(version) over (partition by business_key) as is_active, cast(1 as integer) as chunks, 'PENDING_INGESTION' as status
from (select distinct business_key, version from g where not broken)""")
def batch_documents(spark, sf_dir):
    """The canonical documents of all orders' files, each business key with its newest version active."""
    engine, _ = batch_engine(spark, sf_dir)
    return engine.state("documents").select(F.col("documentId").alias("document_id"), F.col("businessDocumentKey").alias("business_key"), F.col("sourceVersion").alias("source_version"), F.col("isActive").alias("is_active"), F.col("canonicalChunkCount").alias("chunks"), F.col("kbIngestionStatus").alias("status"))


@query(BATCH_SQL + f"""select case when broken then 'FAILED' else 'RESOLVED' end as status, case when not broken then 'doc-' || substr({BATCH_HASH_SQL}, 1, 16) end as document_id, count(distinct case when broken then 0 else o % 2 end) as raw_files from g group by 1, 2""")
def batch_raw_files(spark, sf_dir):
    """The raw contents of all orders' files and what became of them."""
    engine, _ = batch_engine(spark, sf_dir)
    return engine.state("raw_files").groupBy("status", F.nullif("documentId", F.lit("")).alias("document_id")).agg(F.count("*").alias("raw_files"))
