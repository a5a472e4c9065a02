"""Streams over the table files, drained to the end and compared with the batch SQL."""

import uuid

from pyspark.sql import functions as F

from mediacat.plans.work_list import WorkList
from mediacat.session import shared_folder
from mediacat.sources import catalog as C
from mediacat.streaming import jobs, live

from . import inputs, query
from .inputs import Inputs
from .parameters import FEW_LANGUAGES, LANGUAGES, NOW, START

KEY = ["author", "permlink"]


def folder(spark) -> str:
    """A new folder for the checkpoint and output of one run."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def stream(t: Inputs, name: str):
    """A table's files as a stream, with the schema its batch form has. The pattern takes
    one file as well as a folder of files."""
    return jobs.read_stream(t.spark, f"{t.sf_dir}/{name}*.parquet", t.table(name).schema)


def event_stream(t: Inputs):
    return inputs.items(stream(t, "events"))


@query("""select author, permlink, video_type, status, created_at from with_cids where has_cid and
  ((video_type='legacy' and ((status='published' and created_at >= timestamp'1999-01-01')
     or (status='scheduled' and publish_data > timestamp'2000-01-01')))
   or (video_type<>'legacy' and status='published' and created_at >= timestamp'1999-01-01'))""")
def stream_ingest(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    rows = jobs.ingest_catalogs(
        inputs.legacy_rows(stream(t, "orders")), inputs.embed_rows(stream(t, "documents")),
        inputs.audio_rows(stream(t, "pages")), NOW, folder(spark), START,
    )
    return rows.select(*KEY, "video_type", "status", "created_at")


@query("""select owner author, permlink, manifest_cid, createdAt created_at from catalog_embed e where manifest_cid<>'' and status='published'
  and (owner, permlink) not in (select (author, permlink) from state where "language" in ('en','es','fr') group by author, permlink
    having count(distinct "language")=3)""")
def stream_open_work(spark, sf_dir):
    """Rows of any date that lack a language, chosen in each micro-batch by an anti join."""
    t = Inputs(spark, sf_dir)
    rows = C.embed_published(inputs.embed_rows(stream(t, "documents"))).selectExpr(
        "owner author", "permlink", "manifest_cid", "createdAt created_at"
    )
    return jobs.open_work(rows, t.state, FEW_LANGUAGES, folder(spark))


@query("""select author, permlink, "language", subtitle_cid, updated_at, created_at from state""")
def stream_upsert(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    state = jobs.upsert_subtitles(inputs.subtitle_log_rows(event_stream(t)), folder(spark))
    return state.select(*KEY, "language", "subtitle_cid", "updated_at", "created_at")


@query("""select distinct author, permlink from queue_log where (author, permlink) in (select (author, permlink) from catalogs)""")
def stream_dedup_enqueue(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return jobs.dedup_queue(inputs.queue_log_rows(event_stream(t)), t.catalogs, folder(spark))


@query("""select author, permlink, count(distinct "language") n_done, count(distinct "language")=5 is_complete from state group by all""")
def stream_completion(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return jobs.completion(inputs.subtitle_log_rows(event_stream(t)), LANGUAGES, folder(spark))


PRIORITY = """select author, permlink, bucket, requested_at, prio_rank, type_rank, status_rank, row_number() over (order by bucket, requested_at nulls last,
    prio_rank, type_rank, status_rank, created_at nulls first, cat, author, permlink) as "position" from (
  select author, permlink, 0 bucket, requested_at, null::int prio_rank, null::int type_rank, null::int status_rank, null::timestamp created_at, 0 cat from queue
    where (author, permlink) in (select (author, permlink) from catalogs)
  union all select author, permlink, 1, null, case when author in (select author from creators) then 0 else 1 end,
    case video_type when 'embed' then 0 when 'legacy' then 1 else 2 end, case when status='published' then 0 else 1 end, created_at, cat
  from candidates where (author, permlink) not in (select (author, permlink) from queue))"""


@query(PRIORITY)
def stream_priority(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    candidates = C.all_videos(t.legacy, t.embed, t.audio, NOW)
    rows = jobs.prioritised_work(
        inputs.queue_log_rows(event_stream(t)), candidates, t.catalogs, t.creators, folder(spark)
    )
    return rows.drop("created_at")


@query('select "language", count(*) n from state group by all')
def stream_stats(spark, sf_dir):
    log = inputs.subtitle_log_rows(event_stream(Inputs(spark, sf_dir)))
    return jobs.live_counts(log, [*KEY, "language"], ["language"], folder(spark))


@query("""select case when is_audio then 'audio' when is_embed then 'embed' else 'legacy' end video_type, count(*) n from videos group by all""")
def stream_video_counts(spark, sf_dir):
    log = inputs.subtitle_log_rows(event_stream(Inputs(spark, sf_dir)))
    return jobs.live_counts(log, KEY, ["video_type"], folder(spark))


@query("select video_type, count(*) n from available group by all")
def stream_available_counts(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    videos = C.available(
        inputs.legacy_rows(stream(t, "orders")), inputs.embed_rows(stream(t, "documents")),
        inputs.audio_rows(stream(t, "pages")), START,
    )
    return jobs.live_counts(videos, [*KEY, "video_type"], ["video_type"], folder(spark))


def event_batches(t: Inputs, files: int = 4):
    """All events as a stream of several micro-batches, dealt out by number: neither moments nor keys are in order."""
    path = f"{folder(t.spark)}/events"
    t.table("events").repartition(files, "event_id").write.parquet(path)
    return inputs.items(jobs.read_stream(t.spark, path, t.table("events").schema, files_per_batch=1))


@query("""select author, permlink, min(requested_at) requested_at from queue_log left join
  (select author, permlink, max(ts) taken from run_log where source='queue' group by all) using (author, permlink)
  where (taken is null or requested_at>taken) and (author, permlink) in (select (author, permlink) from catalogs where video_type<>'audio')
  group by author, permlink""")
def stream_queue(spark, sf_dir):
    """The queue after all requests and removals, over several batches; audio-only keys are refused."""
    t = Inputs(spark, sf_dir)
    events = event_batches(t)
    taken = inputs.run_log_rows(events).where("source = 'queue'").withColumnRenamed("ts", "taken_at")
    return live.live_queue(inputs.queue_log_rows(events), taken, t.catalogs, folder(spark)).entries()


def _live_state(spark, sf_dir, totals: bool):
    t = Inputs(spark, sf_dir)
    events = event_batches(t)
    deletions = inputs.run_log_rows(events).where("outcome = 'failed'")
    offers = C.available(
        inputs.legacy_rows(stream(t, "orders")), inputs.embed_rows(stream(t, "documents")), inputs.audio_rows(stream(t, "pages")), START,
    )
    if not totals:
        return live.live_state(live.state_events(inputs.subtitle_log_rows(events), deletions), folder(spark), totals=False)
    rows = live.state_events(inputs.subtitle_log_rows(events), deletions, inputs.tag_log_rows(events), offers)
    return live.live_state(rows, folder(spark))


LEFT = """(select l.* from subtitle_log l left join (select author, permlink, max(ts) gone from run_log where outcome='failed' group by all) using (author, permlink)
  where gone is null or l.ts>gone)"""
LEFT_VIDEOS = f"""(select author, permlink, first(video_type order by ts) of_type, count(distinct "language") lang_count from {LEFT} group by author, permlink)"""


@query(f"""select author, permlink, "language", arg_max(subtitle_cid,ts) subtitle_cid, max(ts) updated_at, min(ts) created_at from {LEFT} group by all""")
def stream_subtitle_state(spark, sf_dir):
    """Current subtitles after saves and deletions, over several batches."""
    return _live_state(spark, sf_dir, False).subtitles().select(*KEY, "language", "subtitle_cid", "updated_at", "created_at")


def _of(column: str, kind: str) -> str:
    return f"coalesce(max({column}) filter (video_type='{kind}'),0)"


_KINDS = ("legacy", "embed", "audio")


@query(f"""with per_type as (select video_type, cast(sum(a) as bigint) a, cast(sum(p) as bigint) p, cast(sum(s) as bigint) s from
   (select video_type, 1 a, 0 p, 0 s from available union all select of_type, 0, 1, lang_count from {LEFT_VIDEOS}) group by all)
  select cast(sum(p) as bigint) total_processed, cast(sum(s) as bigint) total_subtitles, (select count(*) from (select distinct author, permlink from tag_log)) total_tagged,
  cast(sum(a) as bigint) total_available, {', '.join(f"{_of('a', k)} total_{k}" for k in _KINDS)}, {', '.join(f"{_of('p', k)} processed_{k}" for k in _KINDS)},
  cast(sum(greatest(0,a-p)) as bigint) pending, {', '.join(f"{_of('greatest(0,a-p)', k)} pending_{k}" for k in _KINDS)} from per_type""")
def stream_totals(spark, sf_dir):
    """Running totals of the monitoring view, with deletions taken back out."""
    return _live_state(spark, sf_dir, True).totals()


@query(f"""select 'language' measure, "language" item, count(*) n from (select distinct author, permlink, "language" from {LEFT}) group by all
  union all select 'open', video_type, count(*) from available where (author, permlink) not in (select (author, permlink) from {LEFT_VIDEOS}) group by all""")
def stream_backlog(spark, sf_dir):
    """Files per language and available videos without subtitles, kept current by the same stream."""
    state = _live_state(spark, sf_dir, True)
    return state.measure("language", "item").select(F.lit("language").alias("measure"), "item", "n").union(
        state.measure("open", "item").select(F.lit("open"), "item", "n"))


@query(PRIORITY)
def work_list(spark, sf_dir):
    """The whole list over a stored order of the candidates, after a stream of requests in several batches."""
    t = Inputs(spark, sf_dir)
    candidates = C.all_videos(t.legacy, t.embed, t.audio, NOW)
    work = WorkList.store(candidates, t.creators, f"{folder(spark)}/candidates")
    no_removals = jobs.read_stream(spark, f"{sf_dir}/events*.parquet", t.table("events").schema).where("false").selectExpr(
        "cast(null as string) author", "cast(null as string) permlink", "ts taken_at")
    queue = live.live_queue(inputs.queue_log_rows(event_batches(t)), no_removals, t.catalogs, folder(spark), include_audio=True)
    work.request(queue.entries())
    return work.rows().drop("created_at")


@query(f"""select author, permlink, bucket, "position" from ({PRIORITY}) where "position" <= 500""")
def work_list_head(spark, sf_dir):
    """What is taken next: the head and the first files of the stored order."""
    t = Inputs(spark, sf_dir)
    work = WorkList.store(C.all_videos(t.legacy, t.embed, t.audio, NOW), t.creators, f"{folder(spark)}/candidates")
    known = t.queue.join(t.catalogs.select(*KEY).distinct(), KEY, "left_semi")
    work.request(known)
    return work.first(500)
