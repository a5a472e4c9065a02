"""Keyed state: subtitle saves, processing times, status, queue, lists."""

from pyspark.sql import functions as F

from mediacat.sinks import lists, subtitles

from . import query
from .inputs import Inputs, author_of

KEY = ["author", "permlink"]


@query("""select author, permlink, "language", subtitle_cid, updated_at, created_at from state""")
def subtitle_upsert(spark, sf_dir):
    return Inputs(spark, sf_dir).state.select(*KEY, "language", "subtitle_cid", "updated_at", "created_at")


@query("select * from videos")
def subtitle_headers(spark, sf_dir):
    return Inputs(spark, sf_dir).videos.drop("languages")


@query("""select author, permlink, string_agg("language"||'='||subtitle_cid, ';' order by "language") subtitles from state group by all""")
def subtitle_map(spark, sf_dir):
    """The language -> subtitle id map of each video (shown as text)."""
    entries = F.map_entries(F.col("subtitles"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return subtitles.as_map(Inputs(spark, sf_dir).state).select(*KEY, text.alias("subtitles"))


@query("""select author, permlink, "language", subtitle_cid from state""")
def subtitle_from_maps(spark, sf_dir):
    """Map form and back."""
    return subtitles.from_maps(subtitles.as_map(Inputs(spark, sf_dir).state))


@query("""select v.author, v.permlink, v.updated_at, r.processing_seconds, r.video_duration_seconds from videos v left join
  (select author, permlink, arg_max(processing_seconds,ts) processing_seconds,
    arg_max(video_duration_seconds,ts) filter (video_duration_seconds<>0) video_duration_seconds
   from run_log where outcome='success' group by all) r on v.author=r.author and v.permlink=r.permlink""")
def processing_time_update(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    done = t.run_log.where(F.col("outcome") == "success")
    return subtitles.with_processing_times(t.videos, done).select(
        *KEY, "updated_at", "processing_seconds", "video_duration_seconds"
    )


@query("select * from in_work")
def status_current(spark, sf_dir):
    return subtitles.current_status(Inputs(spark, sf_dir).status_log)


@query("""select r.author, r.permlink, requested_at, n_requests, case when c.permlink is null then 'not_found'
   when q.permlink is not null then 'duplicate' else 'accepted' end outcome
  from (select author, permlink, min(requested_at) requested_at, count(*) n_requests from queue_log
    where requested_at >= timestamp'2024-01-05' group by all) r
  left join (select distinct author, permlink from catalogs where video_type<>'audio') c on r.author=c.author and r.permlink=c.permlink
  left join (select distinct author, permlink from queue_log where requested_at < timestamp'2024-01-05') q
   on r.author=q.author and r.permlink=q.permlink""")
def queue_enqueue(spark, sf_dir):
    """The first days' requests are the queue; the later ones ask to be added."""
    t = Inputs(spark, sf_dir)
    first = F.col("requested_at") < F.lit("2024-01-05").cast("timestamp_ntz")
    return lists.enqueue(t.queue_log.where(~first), t.catalogs, t.queue_log.where(first))


@query("select author, permlink, requested_at from queue order by requested_at, author, permlink limit 1")
def queue_pop(spark, sf_dir):
    return lists.pop_oldest(Inputs(spark, sf_dir).queue)


@query("""select author, permlink, requested_at from queue except
  select author, permlink, requested_at from (select * from queue order by requested_at, author, permlink limit 1)""")
def queue_after_pop(spark, sf_dir):
    return lists.after_pop(Inputs(spark, sf_dir).queue).select(*KEY, "requested_at")


@query("""select q.author, q.permlink, requested_at, row_number() over (order by requested_at, q.author, q.permlink) queue_pos,
  c.video_type, c.video_type is not null found from queue q left join
  (select * from catalogs qualify row_number() over (partition by author, permlink order by cat)=1) c
  on q.author=c.author and q.permlink=c.permlink""")
def queue_drain(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return lists.drain(t.queue, t.catalogs).select(*KEY, "requested_at", "queue_pos", "video_type", "found")


@query("""select author, permlink, requested_at, (author,permlink) in (select (owner,permlink) from catalog_embed)
   or (author,permlink) in (select (owner,permlink) from catalog_audio) is_embed,
  (author,permlink) in (select (owner,permlink) from catalog_audio) is_audio from queue""")
def queue_flags(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return lists.queue_flags(t.queue, t.catalogs)


@query("""select author, permlink, min(added_at) added_at from (select 'user'||(case when doc_id%8=0 then 0 else doc_id//8 end) author, 'd'||doc_id permlink,
  timestamp'2024-02-01'+to_days(cast(doc_id%7 as int)) added_at from labels where quality=0) i
  where not exists (select 1 from blacklist b where b.author=i.author and b.permlink=i.permlink) group by all""")
def list_insert_if_absent(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    asked = t.table("labels").where("quality = 0").selectExpr(
        f"{author_of('doc_id')} author", "concat('d', doc_id) permlink",
        "timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(cast(doc_id % 7 as int)) added_at",
    )
    return lists.insert_if_absent(t.blacklist, asked, KEY)


@query("""select sha256(author||chr(31)||permlink) item_id, author, permlink from blacklist where
  (author,permlink) not in (select ('user'||(case when doc_id%8=0 then 0 else doc_id//8 end), 'd'||doc_id) from labels where quality=1)""")
def list_delete(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    good = t.table("labels").where("quality = 1").selectExpr(
        f"{author_of('doc_id')} author", "concat('d', doc_id) permlink"
    )
    rows = t.blacklist.select(lists.item_id(KEY).alias("item_id"), *KEY)
    return lists.delete_by_id(rows, good.select(lists.item_id(KEY).alias("item_id")))


@query("""select item_id, item_id in (select sha256(author||chr(31)||permlink) from blacklist) deleted from
  (select sha256('user'||(case when doc_id%8=0 then 0 else doc_id//8 end)||chr(31)||'d'||doc_id) item_id from labels where quality=1)""")
def list_delete_report(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    asked = t.table("labels").where("quality = 1").selectExpr(
        f"{author_of('doc_id')} author", "concat('d', doc_id) permlink"
    )
    ids = asked.select(lists.item_id(KEY).alias("item_id"))
    return lists.deletion_report(t.blacklist.select(lists.item_id(KEY).alias("item_id")), ids)


@query("select author, permlink, requested_at from queue")
def queue_list(spark, sf_dir):
    return lists.oldest_first(Inputs(spark, sf_dir).queue, KEY, "requested_at")


@query("select author, permlink, added_at from blacklist order by added_at desc, author, permlink")
def list_recent(spark, sf_dir):
    return lists.newest_first(Inputs(spark, sf_dir).blacklist, KEY)


REPROCESS = """(select author, permlink, min(ts) requested_at from run_log where outcome='failed' group by all)"""


@query(f"""select author, permlink, requested_at, (author,permlink) in (select (author,permlink) from videos) deleted,
  (author,permlink) not in (select (author,permlink) from queue) enqueued from {REPROCESS}""")
def reprocess(spark, sf_dir):
    return _reprocess(spark, sf_dir)["report"]


@query(f"""select author, permlink, "language", subtitle_cid from state where (author,permlink) not in (select (author,permlink) from {REPROCESS})""")
def reprocess_subtitles_left(spark, sf_dir):
    return _reprocess(spark, sf_dir)["subtitles"].select(*KEY, "language", "subtitle_cid")


@query(f"""select author, permlink, arg_max(tags,ts) tags from tag_log where (author,permlink) not in (select (author,permlink) from {REPROCESS}) group by all""")
def reprocess_tags_left(spark, sf_dir):
    return _reprocess(spark, sf_dir)["tags"].select(*KEY, "tags")


def _reprocess(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    asked = t.run_log.where("outcome = 'failed'").selectExpr(*KEY, "ts requested_at")
    return lists.reprocess(asked, t.state, subtitles.fold_tags(t.tag_log), t.queue)


@query("""select author, permlink, l."language", arg_max(subtitle_cid,l.ts) subtitle_cid, max(l.ts) updated_at, min(l.ts) created_at
  from subtitle_log l left join (select author, permlink, max(ts) gone from run_log where outcome='failed' group by all) d using (author, permlink)
  where gone is null or l.ts>gone group by all""")
def reprocess_then_save(spark, sf_dir):
    """State after deletions in the log: what was saved before one does not come back."""
    t = Inputs(spark, sf_dir)
    deletions = t.run_log.where("outcome = 'failed'").select(*KEY, "ts", "event_id")
    rows = subtitles.fold(subtitles.after_deletions(subtitles.as_state(t.subtitle_log), deletions))
    return rows.select(*KEY, "language", "subtitle_cid", "updated_at", "created_at")


@query("""select author, permlink, min(requested_at) requested_at from queue_log left join
  (select author, permlink, max(ts) taken from run_log where source='queue' group by all) using (author, permlink)
  where taken is null or requested_at>taken group by author, permlink""")
def queue_current(spark, sf_dir):
    """Queue after enqueue and dequeue events; taken keys may be asked for again."""
    t = Inputs(spark, sf_dir)
    taken = t.run_log.where("source = 'queue'").select(*KEY, F.col("ts").alias("taken_at"))
    return lists.current_queue(t.queue_log, taken)
