"""Catalog scans, lookups, selection and work order."""

from pyspark.sql import functions as F

from mediacat.operators import selection as S
from mediacat.sources import catalog as C

from . import query
from .inputs import Inputs
from .parameters import CURSOR, NOW, START, START_TEXT
from .views import WS

KEY = C.KEY
BASE = [*KEY, "video_type", "status", "created_at"]


@query("""select owner author, permlink, filename, status, created from catalog_legacy
  where starts_with(filename,'ipfs://') and status='published' and created >= timestamp'1999-01-01'""")
def catalog_legacy_since(spark, sf_dir):
    rows = C.legacy_published(Inputs(spark, sf_dir).legacy, START)
    return rows.selectExpr("owner author", "permlink", "filename", "status", "created")


@query("""select owner author, permlink, filename, status, created, publish_data from catalog_legacy
  where starts_with(filename,'ipfs://') and status='scheduled' and publish_data > timestamp'2000-01-01'""")
def catalog_scheduled(spark, sf_dir):
    rows = C.legacy_scheduled(Inputs(spark, sf_dir).legacy, NOW)
    return rows.selectExpr("owner author", "permlink", "filename", "status", "created", "publish_data")


@query("""select owner author, permlink, manifest_cid, createdAt created_at from catalog_embed
  where manifest_cid<>'' and status='published' and createdAt >= timestamp'1999-01-01'""")
def catalog_embed_since(spark, sf_dir):
    rows = C.embed_published(Inputs(spark, sf_dir).embed, START)
    return rows.selectExpr("owner author", "permlink", "manifest_cid", "createdAt created_at")


@query("""select owner author, permlink, audio_cid, createdAt created_at from catalog_audio
  where audio_cid<>'' and status='published' and createdAt >= timestamp'1999-01-01'""")
def catalog_audio_since(spark, sf_dir):
    rows = C.audio_published(Inputs(spark, sf_dir).audio, START)
    return rows.selectExpr("owner author", "permlink", "audio_cid", "createdAt created_at")


@query("""select author, permlink, video_type, status, created_at from with_cids where has_cid and
  ((video_type='legacy' and ((status='published' and created_at >= timestamp'1999-06-01')
     or (status='scheduled' and publish_data > timestamp'2000-01-01')))
   or (video_type<>'legacy' and status='published' and created_at >= timestamp'1999-01-01'))""")
def catalog_since_cursor(spark, sf_dir):
    """Legacy rows since an advanced cursor, embed and audio rows since the start date."""
    t = Inputs(spark, sf_dir)
    return C.videos_since(t.legacy, t.embed, t.audio, NOW, CURSOR, START).select(*BASE)


@query("select author, permlink, video_type, status, created_at, filename, manifest_cid, audio_cid from candidates")
def catalog_all(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    videos = C.by_creation(C.all_videos(t.legacy, t.embed, t.audio, NOW))
    return videos.select(*BASE, "filename", "manifest_cid", "audio_cid")


@query("""select q.author, q.permlink, c.video_type, c.status, c.created_at, c.video_type is not null found
  from (select distinct author, permlink from queue_log) q left join
  (select * from catalogs qualify row_number() over (partition by author, permlink order by cat)=1) c
  on q.author=c.author and q.permlink=c.permlink""")
def catalog_lookup(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return C.lookup(t.catalogs, t.queue_log).select(*BASE, "found")


@query("""select author, permlink, video_type, cid, hls_cid, video_type in ('embed','audio') is_embed,
  video_type='audio' is_audio from resolved""")
def resolve_cid(spark, sf_dir):
    rows = S.resolve_cids(Inputs(spark, sf_dir).catalogs)
    return rows.select(*KEY, "video_type", "cid", "hls_cid", *S.type_flags())


@query("""select author, permlink, video_type, route, fetch_cid,
  author||'_'||permlink||'_'||substring(fetch_cid,1,8)||'.mp4' local_name from planned""")
def fetch_plan(spark, sf_dir):
    rows = S.fetch_plan(Inputs(spark, sf_dir).catalogs)
    return rows.select(*KEY, "video_type", "route", "fetch_cid", "local_name")


@query("""select timestamp'1999-01-01' start_date, max(video_created_at) last_processed,
  greatest(timestamp'1999-01-01', max(video_created_at)) effective_start from videos""")
def effective_cursor(spark, sf_dir):
    return S.effective_cursor(Inputs(spark, sf_dir).videos, START_TEXT)


@query(f"""select page_id, case when good then split_part(u,'/',1) end author,
  case when good then substring(u, strpos(u,'/')+1) end permlink,
  case when good then null else 'bad_format' end reason from (select *, strpos(u,'/')>1 and strpos(u,'/')<length(u) good
  from (select page_id, trim(case when page_id%4=0 then regexp_replace(url,'^[a-z]+://','') when page_id%4=1 then '/'||url
   when page_id%4=2 then '  '||replace(url,'/','')||chr(9) else ' '||regexp_replace(url,'^[a-z]+://','')||chr(10) end, {WS}) u from pages))""")
def parse_video_refs(spark, sf_dir):
    refs = Inputs(spark, sf_dir).table("pages").selectExpr(
        "page_id",
        """case page_id % 4 when 0 then regexp_replace(url, '^[a-z]+://', '') when 1 then concat('/', url)
             when 2 then concat('  ', replace(url, '/', ''), '\\t')
             else concat(' ', regexp_replace(url, '^[a-z]+://', ''), '\\n') end ref""",
    )
    return S.parse_refs(refs).drop("ref")


@query("""select author, permlink, video_type, created_at from candidates c
  where author not in (select author from blacklist_authors)
  and not exists (select 1 from blacklist b where b.author=c.author and b.permlink=c.permlink)""")
def blacklist_filter(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    videos = C.all_videos(t.legacy, t.embed, t.audio, NOW)
    return S.without_blacklisted(videos, t.blacklist_authors, t.blacklist).select(
        *KEY, "video_type", "created_at"
    )


@query("""select author, permlink, video_type, author in (select author from creators) is_priority from candidates""")
def priority_flag(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    videos = C.all_videos(t.legacy, t.embed, t.audio, NOW)
    return S.flag_creators(videos, t.creators).select(*KEY, "video_type", "is_priority")


@query("""select author, permlink, video_type, prio_rank, type_rank, status_rank, row_number() over (order by prio_rank, type_rank,
  status_rank, created_at asc nulls first, cat, author, permlink) "position" from (select *,
  case when author in (select author from creators) then 0 else 1 end prio_rank,
  case video_type when 'embed' then 0 when 'legacy' then 1 else 2 end type_rank,
  case when status='published' then 0 else 1 end status_rank from candidates)""")
def work_order(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    videos = C.all_videos(t.legacy, t.embed, t.audio, NOW)
    placed = S.work_positions(videos, t.creators)
    return placed.select(*KEY, "video_type", "prio_rank", "type_rank", "status_rank", "position")


@query("select distinct author from creators")
def priority_creators(spark, sf_dir):
    from mediacat.sources.tables import distinct_authors

    return distinct_authors(Inputs(spark, sf_dir).creators)
