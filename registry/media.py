"""Candidate addresses, fetch outcomes, probes."""

from pyspark.sql import functions as F

from mediacat.operators.selection import fetch_plan
from mediacat.sources import media

from . import query
from .inputs import Inputs
from .parameters import GATEWAYS

KEY = ["author", "permlink"]
G = "(values (0,'https://g0.example/ipfs/'),(1,'https://g1.example/ipfs/')) g(ord,base)"


@query(f"""select author, permlink, route, ord gateway_ord, base||fetch_cid||case when route='hls' then '/manifest.m3u8' else '' end url
  from planned cross join {G} where route<>'skip'""")
def candidate_urls(spark, sf_dir):
    return media.candidate_urls(fetch_plan(Inputs(spark, sf_dir).catalogs), GATEWAYS)


@query(f"""select i.author, i.permlink, ord gateway_ord, base||fetch_cid||case when route='hls' then '/manifest.m3u8' else '' end url
  from (select * from planned where route<>'skip') i left join (select author, permlink, min(ord) filter (where ok) any_ord,
   min(ord) filter (where ok and size_bytes>0) filled_ord from fetch_attempts group by all) s
   on i.author=s.author and i.permlink=s.permlink left join {G} on ord = case when route='hls' then filled_ord else any_ord end""")
def first_success_source(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return media.first_success(fetch_plan(t.catalogs).where(F.col("route") != "skip"), t.fetch_attempts, GATEWAYS)


@query("""select event_id, coalesce(try_cast(json_extract_string(probe,'$.format.duration') as double),0) duration,
  coalesce(try_cast(json_extract_string(probe,'$.format.size') as bigint),0) size,
  case when event_id%3<>0 then 'h264' end video_codec, case when event_id%3<>2 then 'aac' end audio_codec, event_id%3<>2 has_audio from media_probe""")
def media_probe(spark, sf_dir):
    return media.media_info(Inputs(spark, sf_dir).media_probe).drop("probe")
