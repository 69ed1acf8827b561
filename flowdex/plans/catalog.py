"""Registered queries: each reads the driver tables at ``sf_dir`` and runs one
operator (or a chain of them) of the engine over the whole tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB,
tables registered as views) describe the same result with the same column
names.  Averages are rounded to 4 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.functions.documents import HISTO_SUPP, HISTO_VALU, doc_size, mapify
from flowdex.functions.text import decode_utf8, render_email_content
from flowdex.operators import histogram, paging, sqlreport
from flowdex.operators.documents import doc_fields, prepare_documents
from flowdex.session import configure, work_dir
from flowdex.sinks import kafka as kafka_sink
from flowdex.sources import feeds, mail, mailbox, tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return run
    return wrap


# The log view the oracle statements share (events as log records, batch = day).
L = """with L as (
  select event_id, cast(ts as date) batch, event_type host, user_id,
         case when event_id % 2 = 0 then '/var/log/system.log' else '/var/log/auth.log' end path,
         cast(props->>'$.k' as bigint) lineno
  from events)
"""

RUNNING = ("count(*) over (partition by host order by batch "
           "range between unbounded preceding and current row)")


def _events(spark, sf_dir):
    return tables.table(spark, sf_dir, "events")


def _log(spark, sf_dir, host="event_type"):
    return tables.log_messages(_events(spark, sf_dir), host=host)


def _records(spark, sf_dir, host="event_type"):
    return sqlreport.parse_records(_log(spark, sf_dir, host), keep=["event_id", "batch"])


def _round4(df: DataFrame, col: str = "line_a") -> DataFrame:
    return df.withColumn(col, F.round(col, 4))


# --------------------------------------------------------------- SQL analyzer

@register("log_filter", L + """
select event_id, host, lineno from L where path='/var/log/system.log' and lineno>70""")
def log_filter(spark, sf_dir):
    """The report's predicates over parsed log messages."""
    return sqlreport.report_filter(_records(spark, sf_dir)).select("event_id", "host", "lineno")


@register("log_report", L + """
select host, count(host) host_c, round(avg(lineno),4) line_a from L
where path='/var/log/system.log' and lineno>70 group by 1 order by host_c desc, host limit 100""")
def log_report(spark, sf_dir):
    """X4 with the default statement: P3-P5, A5-A7, T1-T2."""
    return _round4(sqlreport.sql_analyzer(_log(spark, sf_dir)))


@register("log_report_top100", L + """
select cast(user_id as varchar) host, count(cast(user_id as varchar)) host_c, round(avg(lineno),4) line_a
from L where path='/var/log/system.log' and lineno>70 group by 1 order by host_c desc, host limit 100""")
def log_report_top100(spark, sf_dir):
    """The default statement where the limit of 100 bites (host = user id)."""
    return _round4(sqlreport.sql_analyzer(_log(spark, sf_dir, host="user_id")))


@register("log_report_by_batch", L + """
select batch, host, count(host) host_c, round(avg(lineno),4) line_a from L
where path='/var/log/system.log' and lineno>70 group by 1,2
qualify row_number() over (partition by batch order by count(host) desc, host) <= 100""")
def log_report_by_batch(spark, sf_dir):
    """The report per micro-batch (batch = day) on the table form."""
    return _round4(sqlreport.report_by_batch(_records(spark, sf_dir)))


@register("log_report_json", L + """
select '{"host":"' || host || '","count":' || count(host) || ',"mean":'
       || cast(avg(lineno) as decimal(18,2)) || '}' as value
from L where path='/var/log/system.log' and lineno>70 group by host""")
def log_report_json(spark, sf_dir):
    """report rows rendered as escaped JSON text."""
    report = sqlreport.sql_analyzer(_log(spark, sf_dir))
    return sqlreport.render_report(report, mean_decimals=2)


@register("sql_analyzer", L + """
select path, min(lineno) lo, max(lineno) hi, count(*) n from L group by 1""")
def sql_analyzer_inferred(spark, sf_dir):
    """A caller's statement over a schema inferred from the messages."""
    statement = ("SELECT path, MIN(lineno) AS lo, MAX(lineno) AS hi, COUNT(*) AS n "
                 "FROM {logstash} GROUP BY path")
    return sqlreport.sql_analyzer(_log(spark, sf_dir), statement=statement, schema=None)


@register("sql_analyzer_custom", L + """
select '{"path":"' || path || '","lo":' || min(lineno) || ',"hi":' || max(lineno) || ',"logstash":' || count(*) || '}' as value
from L where path <> 'FROM logstash' group by path""")
def sql_analyzer_custom(spark, sf_dir):
    """A caller's statement through the analyzer's default settings; the view's name is an alias and a text too."""
    from flowdex.plans.analyzers import SqlAnalyzer
    statement = ("SELECT logstash.path, MIN(lineno) AS lo, MAX(lineno) AS hi, COUNT(*) AS logstash "
                 "FROM logstash WHERE path <> 'FROM logstash' GROUP BY logstash.path")
    return SqlAnalyzer(statement=statement)(_log(spark, sf_dir))


# ------------------------------------------------------------ documents

@register("message_mapify", """
select event_id, 'k' as key, props->>'$.k' as val from events""")
def message_mapify(spark, sf_dir):
    """P1 on valid JSON: every member becomes a text entry."""
    docs = _events(spark, sf_dir).select("event_id", mapify("props").alias("doc"))
    return docs.select("event_id", F.explode("doc").alias("key", "val"))


@register("message_mapify_invalid", """
select doc_id, 0 as n_keys from documents""")
def message_mapify_invalid(spark, sf_dir):
    """P1 on free text (whole documents): unparsable -> empty document."""
    docs = tables.table(spark, sf_dir, "documents")
    return docs.select("doc_id", doc_size(mapify("text")).alias("n_keys"))


@register("field_values", L + """
select event_id, host as histo_valu from L""")
def field_values(spark, sf_dir):
    """The histogram field's value per message."""
    docs = histogram.with_documents(_log(spark, sf_dir), "host")
    return docs.select("event_id", HISTO_VALU)


@register("index_prepare", L + """
select event_id, host, path, cast(lineno as varchar) lineno from L""")
def index_prepare(spark, sf_dir):
    """K1: message text -> flat string document."""
    docs = prepare_documents(_log(spark, sf_dir), keep=["event_id"])
    return doc_fields(docs, ["host", "path", "lineno"], keep=["event_id"])


# ---------------------------------------------------------------- histogram (A/J/F/T3)

@register("field_support", L + """
select host as histo_valu, count(*) n from L group by 1""")
def field_support(spark, sf_dir):
    """A2: global support per value."""
    return histogram.field_support(histogram.with_documents(_log(spark, sf_dir), "host"))


@register("field_support_by_batch", L + """
select batch, host as histo_valu, count(*) n from L group by 1,2""")
def field_support_by_batch(spark, sf_dir):
    """A1: support per value per batch."""
    return histogram.field_support_by_batch(histogram.with_documents(_log(spark, sf_dir), "host"))


@register("field_support_running", L + """
select batch, histo_valu, cast(sum(n) over (partition by histo_valu order by batch) as bigint) n
from (select batch, host histo_valu, count(*) n from L group by 1,2)""")
def field_support_running(spark, sf_dir):
    """A3: running support per value, current batch included."""
    docs = histogram.with_documents(_log(spark, sf_dir), "host")
    return histogram.running_support(histogram.field_support_by_batch(docs))


@register("histogram_enrich", L + f"""
select event_id, host as histo_valu, {RUNNING} as histo_supp from L""")
def histogram_enrich(spark, sf_dir):
    """X3 on the table form: A1 -> A3 -> J1."""
    out = histogram.enrich(_log(spark, sf_dir), "host")
    return out.select("event_id", HISTO_VALU, HISTO_SUPP)


@register("histogram_enrich_json", L + f"""
select event_id, '{{"host":"' || host || '","path":"' || path || '","lineno":"' || lineno
  || '","histo_field":"host","histo_valu":"' || host || '","histo_supp":"' || {RUNNING} || '"}}' as value
from L""")
def histogram_enrich_json(spark, sf_dir):
    """X3 + F1-F3: enriched documents as JSON text."""
    return histogram.render(histogram.enrich(_log(spark, sf_dir), "host"), keep=["event_id"])


@register("histogram_topk", L + """
select host as histo_valu, count(*) n from L group by 1 order by n desc, 1 limit 3""")
def histogram_topk(spark, sf_dir):
    """T3 (extension): the 3 most frequent values."""
    support = histogram.field_support(histogram.with_documents(_log(spark, sf_dir), "host"))
    return histogram.top_k(support, 3)


@register("histogram_topk_by_batch", L + """
, b as (select distinct batch from L),
c as (select batch, cast(user_id as varchar) v, count(*) n from L group by all),
s as (select b.batch, v, sum(n)::bigint n from b join c on c.batch <= b.batch group by all)
select batch, row_number() over (partition by batch order by n desc, v) as rank, v as histo_valu, n from s
qualify rank <= 10""")
def histogram_topk_by_batch(spark, sf_dir):
    """T3 (extension): the 10 most frequent values after every batch, values absent from it included."""
    docs = histogram.with_documents(_log(spark, sf_dir, host="user_id"), "host")
    running = histogram.running_support(histogram.field_support_by_batch(docs))
    return histogram.running_top_k(running, 10)


# ------------------------------------------------------------------------ feeds

@register("record_values", """
select text as value from documents""")
def record_values(spark, sf_dir):
    """S5 + S7: keyed byte records -> text values (key dropped)."""
    return feeds.record_values(tables.keyed_records(tables.table(spark, sf_dir, "documents")))


@register("utf8_decode", """
select doc_id, md5(text) as text_md5 from documents""")
def utf8_decode(spark, sf_dir):
    """Bytes -> UTF-8 text over whole documents."""
    recs = tables.keyed_records(tables.table(spark, sf_dir, "documents"))
    return recs.select("doc_id", F.md5(decode_utf8("value")).alias("text_md5"))


@register("topic_list", """
select doc_id, source from documents where source in ('src0','src3','src7')""")
def topic_list(spark, sf_dir):
    """Subscription to a comma-separated topic list."""
    recs = tables.keyed_records(tables.table(spark, sf_dir, "documents"))
    return feeds.subscribe_topics(recs, "src0, src3,,src7").select("doc_id", F.col("topic").alias("source"))


@register("topic_pattern", """
select doc_id, source from documents where regexp_full_match(source, 'src1[0-4]')""")
def topic_pattern(spark, sf_dir):
    """S3: whitelist subscription (whole-name regex)."""
    recs = tables.keyed_records(tables.table(spark, sf_dir, "documents"))
    return feeds.subscribe_pattern(recs, "src1[0-4]").select("doc_id", F.col("topic").alias("source"))


@register("topic_prefix", """
select conv_id, turn, text as value from conversations where starts_with(role, 'us')""")
def topic_prefix(spark, sf_dir):
    """Prefix subscription on frame 0 of multi-frame messages."""
    msgs = tables.frame_messages(tables.table(spark, sf_dir, "conversations"))
    msgs = msgs.withColumn("topic", feeds.topic_frame("frames"))
    subscribed = feeds.subscribe_prefix(msgs, "us")
    return subscribed.select("conv_id", "turn", decode_utf8(F.col("frames").getItem(1)).alias("value"))


@register("frame_flatten", """
select conv_id, turn, 0::bigint as pos, role as value from conversations
union all
select conv_id, turn, 1::bigint as pos, text as value from conversations""")
def frame_flatten(spark, sf_dir):
    """Every frame becomes a message; ``pos`` keeps the frame order."""
    msgs = tables.frame_messages(tables.table(spark, sf_dir, "conversations"))
    return feeds.flatten_frames(msgs, keep=["conv_id", "turn"])


@register("interaction_feed", """
select event_id, event_type, value from events where event_type <> 'error' and value > 50""")
def interaction_feed(spark, sf_dir):
    """Deletes dropped, server-side query as a Spark predicate."""
    feed = feeds.interaction_feed(tables.interactions(_events(spark, sf_dir)), query="value > 50")
    return feed.select(F.from_json("value", feeds.INTERACTION_SCHEMA).alias("i")).select("i.*")


@register("status_messages", """
select event_id, case event_type when 'error' then 'Error' when 'view' then 'Info' else 'Warning' end
       || ':' || chr(10) || props as message
from events""")
def status_messages(spark, sf_dir):
    """Status classification as a side-output table."""
    return feeds.status_messages(tables.status_feed(_events(spark, sf_dir)), keep=["event_id"])


@register("kafka_records", """
select source as topic, cast(doc_id as varchar) as "key", md5(text) as value_md5 from documents""")
def kafka_records(spark, sf_dir):
    """K4: outgoing (key, value, topic) byte records."""
    docs = tables.table(spark, sf_dir, "documents")
    recs = kafka_sink.records(docs, value_col="text", key_col="doc_id", topic_col="source")
    return recs.select("topic", decode_utf8("key").alias("key"), F.md5("value").alias("value_md5"))


@register("kafka_binary_keys", """
select source as topic, upper(md5(text)) as key_hex, md5(text) as value_md5 from documents""")
def kafka_binary_keys(spark, sf_dir):
    """K4: keys of raw bytes (not text) leave as they are."""
    docs = tables.table(spark, sf_dir, "documents").withColumn("digest", F.unhex(F.md5("text")))
    recs = kafka_sink.records(docs, value_col="text", key_col="digest", topic_col="source")
    return recs.select("topic", F.hex("key").alias("key_hex"), F.md5("value").alias("value_md5"))


@register("analyzer_identity", """
select event_id, event_type from events""")
def analyzer_identity(spark, sf_dir):
    """No analyzer -> messages pass unchanged."""
    from flowdex.plans.analyzers import apply_analyzer
    ev = _events(spark, sf_dir)
    msgs = ev.select("event_id", F.to_json(F.struct("event_type")).alias("value"))
    out = apply_analyzer(msgs, None)
    return out.select("event_id", F.get_json_object("value", "$.event_type").alias("event_type"))


# ------------------------------------------------------------------------- mail

@register("mail_sender", """
select s_suppkey as msg_no, case s_suppkey % 10 when 0 then 'Null' when 1 then 'Empty'
       else s_name || coalesce(',' || n_name, '') end as sender
from supplier left join nation on s_nationkey = n_nationkey""")
def mail_sender(spark, sf_dir):
    """Sender list rendering, missing and empty lists included."""
    senders = tables.mail_senders(tables.table(spark, sf_dir, "supplier"),
                                  tables.table(spark, sf_dir, "nation"))
    return senders.select("msg_no", mail.render_sender("from").alias("sender"))


def _raw_mail(spark, sf_dir):
    return tables.raw_mail(tables.table(spark, sf_dir, "documents"), tables.table(spark, sf_dir, "pages"))


def _mail_page(spark, sf_dir, take, drop, bucket_rows):
    # The box's message numbers are the documents' ids: the page's place is found without building any mail.
    keys = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("msg_no"))
    mails = mail.mail_page(_raw_mail(spark, sf_dir), take=take, drop=drop, folder=None, keys=keys,
                           bucket_rows=bucket_rows)
    email = mail.flatten_mail(mails)
    return email.select("msg_no", "folder", F.col("from").alias("sender"), "subject",
                        F.md5(F.col("content")[0]["content"]).alias("body_md5"))


MAIL_HEADERS = """source as folder,
       case when doc_id % 3 = 0 then 'Feed ' || source || ' <' || source || '@feed.example>'
            else source || '@feed.example' end as sender,
       case when doc_id % 4 = 0 then 'Größe ' || doc_id else 'document ' || doc_id end as subject"""


@register("mail_page", f"""
select doc_id as msg_no, {MAIL_HEADERS}, md5(text) as body_md5 from documents order by doc_id limit 10 offset 20""")
def mail_page(spark, sf_dir):
    """Drop 20, take 10 in mailbox order, whole messages."""
    return _mail_page(spark, sf_dir, 10, 20, paging.BUCKET_ROWS)


@register("mail_page_deep", f"""
select doc_id as msg_no, {MAIL_HEADERS}, md5(text) as body_md5 from documents order by doc_id limit 40 offset 150""")
def mail_page_deep(spark, sf_dir):
    """S16 across buckets: small buckets, so that the page lies beyond the first and spans several."""
    return _mail_page(spark, sf_dir, 40, 150, 20)


@register("event_rank", """
select event_id, row_number() over (order by event_id) as rank from events""")
def event_rank(spark, sf_dir):
    """The ranking that pages are cut by, over the whole of a table."""
    return paging.global_rank(_events(spark, sf_dir).select("event_id"), "event_id", "rank", bucket_rows=500)


@register("mail_headers", f"""
select doc_id as msg_no, {MAIL_HEADERS} from documents""")
def mail_headers(spark, sf_dir):
    """Sender with display name and decoded subject of every raw message."""
    emails = mail.flatten_mail(_raw_mail(spark, sf_dir))
    return emails.select("msg_no", "folder", F.col("from").alias("sender"), "subject")


MAIL_PARTS = """
select doc_id as msg_no, 0::bigint as pos, 'TEXT/PLAIN' as msg_type, md5(text) as body_md5,
       md5('EmailContent(' || text || ' (...),TEXT/PLAIN)') as shown_md5 from documents
union all
select doc_id, 1::bigint, 'TEXT/HTML', md5(html), md5('EmailContent(' || html || ' (...),TEXT/HTML)')
from documents join pages on doc_id = page_id"""


def mail_parts(emails: DataFrame) -> DataFrame:
    """Parts of mails with the digests of their content and of its rendering."""
    return mail.explode_content(emails).select(
        "msg_no", "pos", "msg_type", F.md5("content").alias("body_md5"),
        F.md5(render_email_content("content", "msg_type")).alias("shown_md5"))


@register("mail_flatten", MAIL_PARTS)
def mail_flatten(spark, sf_dir):
    """S18 + F6: RFC 822 parse -> one row per HTML / plain part."""
    return mail_parts(mail.flatten_mail(_raw_mail(spark, sf_dir)))


@register("mbox_mail", f"""
select row_number() over (order by doc_id) as msg_no, subject, sender, md5(rtrim(text, chr(10) || chr(13))) as body_md5 from (
  select doc_id, text, {MAIL_HEADERS} from documents)""")
def mbox_mail(spark, sf_dir):
    """S15 + S18: mbox files read in ranges, numbered in file order, parsed."""
    box = f"{work_dir(spark, 'mbox')}/inbox"
    mailbox.write_mbox(_raw_mail(spark, sf_dir).repartitionByRange("msg_no").sortWithinPartitions("msg_no"), box)
    emails = mail.flatten_mail(mailbox.number_mails(mailbox.read_mbox(spark, box), folder="box"))
    body = F.rtrim(F.col("content")[0]["content"], F.lit("\n\r"))
    return emails.select("msg_no", "subject", F.col("from").alias("sender"), F.md5(body).alias("body_md5"))


@register("mail_page_by_folder", f"""
select doc_id as msg_no, {MAIL_HEADERS}, md5(text) as body_md5 from documents order by source, doc_id limit 40 offset 90""")
def mail_page_by_folder(spark, sf_dir):
    """S16 in another order: by folder (a text with heavy ties), then number."""
    mails = paging.page_by(_raw_mail(spark, sf_dir), ["folder", "msg_no"], drop=90, take=40)
    return mail.flatten_mail(mails).select("msg_no", "folder", F.col("from").alias("sender"), "subject",
                                           F.md5(F.col("content")[0]["content"]).alias("body_md5"))


# Streaming forms register themselves into the same tables.
from flowdex.plans import streams  # noqa: E402,F401
