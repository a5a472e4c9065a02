"""Totals, backlogs, feeds and pages."""

import uuid

from pyspark.sql import functions as F

from mediacat.operators.key_filter import anti_join
from mediacat.plans import monitoring as M
from mediacat.session import shared_folder
from mediacat.sinks.subtitles import current_status, with_processing_times
from mediacat.sources.catalog import available as published

from . import query
from .inputs import Inputs
from .parameters import START, START_TEXT

TYPE = "case when is_audio then 'audio' when is_embed then 'embed' else 'legacy' end"
BACKLOG = f"""(select video_type, cast(sum(a) as bigint) available, cast(sum(p) as bigint) processed, cast(sum(s) as bigint) subtitles,
  greatest(0,cast(sum(a)-sum(p) as bigint)) pending from (select video_type, 1 a, 0 p, 0 s from available union all
  select {TYPE}, 0, 1, lang_count from videos) group by all)"""


def _per(stem, column):
    return ", ".join(
        f"coalesce(cast(max({column}) filter (video_type='{k}') as bigint),0) {stem}_{k}" for k in ("legacy", "embed", "audio")
    )


STATS = f"""(select cast(sum(processed) as bigint) total_processed, cast(sum(subtitles) as bigint) total_subtitles,
  (select count(*) from (select distinct author, permlink from tag_log)) total_tagged, cast(sum(available) as bigint) total_available,
  {_per('total','available')}, {_per('processed','processed')}, cast(sum(pending) as bigint) pending, {_per('pending','pending')} from {BACKLOG})"""
RECENT = """(select * from (select author, permlink, video_type, cat, created_at from available where video_type='legacy' order by created_at desc, author, permlink limit 20)
 union all select * from (select author, permlink, video_type, cat, created_at from available where video_type='embed' order by created_at desc, author, permlink limit 20)
 union all select * from (select author, permlink, video_type, cat, created_at from available where video_type='audio' order by created_at desc, author, permlink limit 20))"""
PENDING = f"""(select author, permlink, case when author in (select author from creators) then 'prioritized' else 'pending' end state,
  video_type in ('embed','audio') is_embed, video_type='audio' is_audio, '' languages, 0::bigint lang_count, created_at display_date,
  null::int processing_seconds, null::int video_duration_seconds from {RECENT}
  where (author,permlink) not in (select (author,permlink) from videos) and (author,permlink) not in (select (author,permlink) from queue_log)
  and (author,permlink) not in (select (author,permlink) from in_work) order by created_at desc, cat, author, permlink limit 50)"""
RAN = """(select author, permlink, arg_max(processing_seconds,ts) processing_seconds,
  arg_max(video_duration_seconds,ts) filter (video_duration_seconds<>0) video_duration_seconds from run_log where outcome='success' group by all)"""
COMPLETED = f"""(select v.author, v.permlink, 'complete' state, is_embed, is_audio, languages, lang_count, coalesce(updated_at,created_at) display_date,
  processing_seconds, video_duration_seconds
  from (select * from videos order by updated_at desc, author, permlink limit 50) v join lang_lists l on v.author=l.author and v.permlink=l.permlink
  left join {RAN} r on v.author=r.author and v.permlink=r.permlink)"""
FEED = f"""(select 1 section, author, permlink, 'processing' state, is_embed, is_audio, '' languages, 0 lang_count, started_at display_date,
   null::int processing_seconds, null::int video_duration_seconds from in_work
 union all select 2, author, permlink, 'prioritized', (author,permlink) in (select (owner,permlink) from catalog_embed)
   or (author,permlink) in (select (owner,permlink) from catalog_audio), (author,permlink) in (select (owner,permlink) from catalog_audio), '', 0, requested_at, null, null from queue
 union all select 3, * from {COMPLETED} union all select 4, * from {PENDING})"""
PAGE_COLUMNS = "author, permlink, is_embed, is_audio, languages, created_at, updated_at, video_created_at, display_date, has_more"


def iso(c):
    return (f"case when microsecond({c})%1000000=0 then strftime({c},'%Y-%m-%dT%H:%M:%S')"
            f" else strftime({c},'%Y-%m-%dT%H:%M:%S.%f') end {c}")


def page_sql(page, size):
    skip = (page - 1) * size
    return f"""select {page} page, v.author, v.permlink, is_embed, is_audio, languages, {iso('created_at')}, {iso('updated_at')}, {iso('video_created_at')},
  {iso('display_date')}, {skip}+count(*) over () < total has_more, processing_seconds, video_duration_seconds from (select *, updated_at display_date, count(*) over () total from videos
  order by updated_at desc, author, permlink limit {size} offset {skip}) v join lang_lists l on v.author=l.author and v.permlink=l.permlink
  left join {RAN} r on v.author=r.author and v.permlink=r.permlink"""


def available(t: Inputs):
    return published(t.legacy, t.embed, t.audio, START)


def finished(t: Inputs):
    """Videos with the processing time and length of their last successful run."""
    return with_processing_times(t.videos, t.run_log.where("outcome = 'success'"))


def feed(t: Inputs):
    return M.activity_feed(available(t), t.catalogs, finished(t), t.queue, current_status(t.status_log), t.creators)


@query(f"select * from {STATS}")
def stats_summary(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return M.stats_summary(available(t), t.videos, t.tag_log)


@query(f"""select to_json({{start_date: '1999-01-01', total_processed: total_processed, total_subtitles: total_subtitles, total_tagged: total_tagged,
  total_available: total_available, total_legacy: total_legacy, total_embed: total_embed, total_audio: total_audio,
  processed_legacy: processed_legacy, processed_embed: processed_embed, processed_audio: processed_audio, pending: pending,
  pending_legacy: pending_legacy, pending_embed: pending_embed, pending_audio: pending_audio,
  generated_at: '2000-01-01 00:00:00'}})::varchar stats from {STATS}""")
def stats_json(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return M.stats_json(M.stats_summary(available(t), t.videos, t.tag_log), "2000-01-01 00:00:00", START_TEXT)


@query('select "language", count(*) n from state group by all')
def language_counts(spark, sf_dir):
    return M.language_counts(Inputs(spark, sf_dir).state)


@query("select video_type, count(*) n from available group by all")
def available_counts(spark, sf_dir):
    return available(Inputs(spark, sf_dir)).groupBy("video_type").agg(F.count("*").alias("n"))


@query(f"select video_type, available, processed, pending from {BACKLOG}")
def backlog_counts(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return M.backlog_counts(available(t), t.videos)


@query("""select author, permlink, video_type from available where (author,permlink) not in (select (author,permlink) from videos)""")
def filtered_open_videos(spark, sf_dir):
    """Available videos without subtitles; those whose key is certainly not among the processed ones are not shuffled."""
    t = Inputs(spark, sf_dir)
    processed = t.state.select("author", "permlink").distinct()
    return anti_join(available(t).select("author", "permlink", "video_type"), processed, ["author", "permlink"])


@query("""select video_type, count(*) pending from available where (author,permlink) not in (select (author,permlink) from videos) group by all""")
def backlog_exact(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return M.backlog_exact(available(t), t.videos)


@query("select count(*) n_processed from videos where created_at >= timestamp'2024-01-02'")
def processed_since(spark, sf_dir):
    return M.processed_since(Inputs(spark, sf_dir).videos, F.lit("2024-01-02").cast("timestamp_ntz"))


@query(f"select * from {COMPLETED}")
def recent_completed(spark, sf_dir):
    return M.recent_completed(finished(Inputs(spark, sf_dir)))


@query(f"select * from {PENDING}")
def recent_pending(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return M.recent_pending(available(t), t.videos, t.queue, current_status(t.status_log), t.creators)


@query(f"select author, permlink, video_type, created_at from {RECENT}")
def recent_candidates(spark, sf_dir):
    return M.recent_candidates(available(Inputs(spark, sf_dir)))


@query(f"select * from {FEED}")
def activity_feed(spark, sf_dir):
    return feed(Inputs(spark, sf_dir))


@query(f"select * from {FEED} where state<>'complete'")
def feed_pending(spark, sf_dir):
    return M.feed_pending(feed(Inputs(spark, sf_dir)))


@query(f"select * from {FEED} where state='complete'")
def feed_complete(spark, sf_dir):
    return M.feed_complete(finished(Inputs(spark, sf_dir)))


@query(page_sql(2, 50))
def processed_page(spark, sf_dir):
    return M.processed_page(finished(Inputs(spark, sf_dir)), page=2, per_page=50)


@query(page_sql(3, 100))
def processed_page_deep(spark, sf_dir):
    """The path of deep pages: cut by row positions. Page size is held at its maximum."""
    return M.processed_page(finished(Inputs(spark, sf_dir)), page=3, per_page=500)


@query(f"select * from ({page_sql(1, 50)}) union all select * from ({page_sql(4, 50)})")
def stored_pages(spark, sf_dir):
    """A first and a deeper page of one stored order."""
    table = M.store_finished(finished(Inputs(spark, sf_dir)), f"{shared_folder(spark)}/finished-{uuid.uuid4().hex}")
    return M.stored_page(table, 1, 50).union(M.stored_page(table, 4, 50))


@query(f"""select author, permlink, "position" from (select *, row_number() over (order by updated_at desc, author, permlink) "position" from videos)
  where "position" between 21 and 120""")
def page_by_key(spark, sf_dir):
    """The hundred videos that follow the last one of a first page of 20, found by its key."""
    t = Inputs(spark, sf_dir)
    table = M.store_finished(t.videos, f"{shared_folder(spark)}/finished-{uuid.uuid4().hex}")
    last = table.between(20, 20).first()
    return table.after((last["updated_at"], last["author"], last["permlink"]), 100).select("author", "permlink", "position")


@query("""select count(*) total, count_if(outcome='success')::bigint successful, count_if(outcome='failed')::bigint failed from run_log where source='batch'""")
def run_summary(spark, sf_dir):
    return M.run_summary(Inputs(spark, sf_dir).run_log)
