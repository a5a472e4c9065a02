"""The same domain tables as SQL views, and their use in check queries."""

from __future__ import annotations

import re

from mediacat.functions.fixed_values import WHITESPACE

from .parameters import CORRECTIONS, LANGUAGES, TAGS

WS = "'" + WHITESPACE + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("null" if v is None else repr(v) for v in row) + ")" for row in rows)


def ms(seconds: str) -> str:
    return f"(cast(floor({seconds}) as bigint)*1000 + cast(floor(({seconds} % 1)*1000) as bigint))"


def timecode(seconds: str) -> str:
    t = f"cast(floor({seconds}) as bigint)"
    return (
        f"printf('%02d:%02d:%02d,%03d', {t}//3600, ({t}//60)%60, {t}%60,"
        f" cast(floor(({seconds} % 1)*1000) as bigint))"
    )


def corrections(text: str) -> str:
    for old, new in CORRECTIONS:
        text = f"regexp_replace({text}, '{re.escape(old)}', '{new}', 'gi')"
    return text


_ITEM = (
    "'user'||(case when item%8=0 then 0 else item//8 end) author, (case video_type when 'embed' then 'd' when 'audio' then 'a' else 'v' end)||item permlink"
)

VIEWS = {
    "languages": f"select * from (values {_values((x.ord, x.code, x.max_duration) for x in LANGUAGES)})"
                 " t(ord, code, max_duration)",
    "tag_seeds": f"select * from (values {_values((x.ord, x.label, x.seed) for x in TAGS)}) t(ord, label, seed)",
    "catalog_legacy": """select 'user'||(case when o_orderkey%8=0 then 0 else o_orderkey//8 end) owner,'v'||o_orderkey permlink,
 case o_orderkey%10 when 0 then null when 1 then '' when 2 then 'http://x/'||o_orderkey else 'ipfs://Qm'||o_orderkey end filename,
 case when o_orderkey%3=0 then 'ipfs://Hl'||o_orderkey||'/manifest.m3u8' end video_v2,
 case o_orderstatus when 'F' then 'published' when 'P' then 'scheduled' else 'draft' end status,
 case when o_orderstatus='P' and o_orderkey%4=0 then null else o_orderdate end created,
 o_orderdate+to_days(30) publish_data, cast(null as varchar) description from orders""",
    "catalog_embed": """select 'user'||(case when doc_id%8=0 then 0 else doc_id//8 end) owner,'d'||doc_id permlink,
 case when doc_id%13=0 then null when doc_id%17=0 then '' else 'Em'||doc_id end manifest_cid,
 case when doc_id%7=0 then 'draft' else 'published' end status,
 timestamp'1998-01-01 00:00:00'+to_days(cast(doc_id%1000 as int)) createdAt, text description, lang, source from documents""",
    "catalog_audio": """select 'user'||(case when page_id%8=0 then 0 else page_id//8 end) owner,'a'||page_id permlink,
 case when page_id%11=0 then null else 'Au'||page_id end audio_cid,
 case when page_id%7=0 then 'draft' else 'published' end status,
 timestamp'1999-01-01 00:00:00'+to_days(cast(page_id%500 as int)) createdAt from pages""",
    "catalogs": """select owner author, permlink, 'legacy' video_type, 0 cat, status, created created_at, filename, video_v2,
  cast(null as varchar) manifest_cid, cast(null as varchar) audio_cid, description, publish_data from catalog_legacy
 union all select owner, permlink, 'embed', 1, status, createdAt, null, null, manifest_cid, null, description, null from catalog_embed
 union all select owner, permlink, 'audio', 2, status, createdAt, null, null, null, audio_cid, null, null from catalog_audio""",
    "with_cids": """select *, (video_type='legacy' and starts_with(filename,'ipfs://')) or (video_type='embed' and manifest_cid<>'')
  or (video_type='audio' and audio_cid<>'') has_cid from catalogs""",
    "candidates": """select * from with_cids where has_cid and (status='published'
  or (status='scheduled' and video_type='legacy' and publish_data > timestamp'2000-01-01'))""",
    "available": """select * from with_cids where has_cid and status='published' and created_at>=timestamp'1999-01-01'""",
    "resolved": r"""select *, case when video_type='legacy' then nullif(regexp_replace(regexp_replace(video_v2,'^ipfs://',''),'/manifest\.m3u8$',''),'') end hls_cid,
  nullif(case video_type when 'audio' then audio_cid when 'embed' then manifest_cid else regexp_replace(filename,'^ipfs://','') end,'') cid from catalogs""",
    "planned": """select *, case when cid is null and hls_cid is null then 'skip' when video_type='embed' or hls_cid is not null then 'hls' else 'direct' end route,
  coalesce(hls_cid,cid) fetch_cid from resolved""",
    "words": r"""select author,permlink,word_idx,cast(word_idx//20 as bigint) raw_seg,' '||tok word,cast(word_idx as double)*cast(0.4 as double) start_s,
  (cast(word_idx as double)+1)*cast(0.4 as double) end_s from (select 'user'||(case when doc_id%8=0 then 0 else doc_id//8 end) author,'d'||doc_id permlink,
  unnest(range(len(toks))) word_idx, unnest(toks) tok from (select doc_id, list_filter(regexp_split_to_array(text,'\s+'), lambda x: x<>'') toks from documents))""",
    "word_marks": f"""select *, count(*) over (partition by author,permlink,raw_seg) n,
  coalesce(sum(case when regexp_matches(trim(word,{WS}),'[.!?]$') then 1 else 0 end) over (partition by author,permlink,raw_seg order by word_idx
   rows between unbounded preceding and 1 preceding),0) sid from words""",
    "word_chunks": """select *, case when n<=8 then 0 else sid end sent, case when n<=8 then 0 else
  (row_number() over (partition by author,permlink,raw_seg,sid order by word_idx)-1)//8 end chunk from word_marks""",
    "cue_groups": f"""select author,permlink,raw_seg,sent,chunk,min(word_idx) w0,max(n) n,arg_min(start_s,word_idx) start_s,
  arg_max(end_s,word_idx) end_s, trim(string_agg(word,'' order by word_idx),{WS}) text from word_chunks group by all""",
    "cues": """select author,permlink,raw_seg,row_number() over (partition by author,permlink,raw_seg order by w0)-1 cue_in_seg,
  start_s,end_s,text, row_number() over (partition by author,permlink order by raw_seg,w0)-1 seg_idx from cue_groups where n<=8 or text<>''""",
    "durations": """select author,permlink,arg_max(end_s,seg_idx) duration_s, arg_max(end_s,seg_idx)/cast(60 as double) duration_min
  from cues group by all""",
    "segments": """select 'user'||(case when conv_id%8=0 then 0 else conv_id//8 end) author,'c'||conv_id permlink,turn seg_idx,cast(turn as double)*5 start_s,
 cast(turn as double)*5+least(cast(length(text) as double)/20,6) end_s,
 case when (conv_id+turn)%23=0 then '' else text end text from conversations""",
    "seg_durations": """select author,permlink,arg_max(end_s,seg_idx) duration_s, arg_max(end_s,seg_idx)/cast(60 as double) duration_min
  from segments group by all""",
    "rendered": f"""select author,permlink,'en' "language", string_agg(no||chr(10)||{timecode('start_s')}||' --> '||{timecode('end_s')}||chr(10)||trim(text,{WS})
  ||chr(10)||chr(10),'' order by no) srt, count(*) cue_count from (select *, row_number() over (partition by author,permlink order by seg_idx) no from segments)
  group by author,permlink""",
    "ev": "select *, event_id%10 op, cast(event_id//10 as bigint) n from events",
    "ev_item": """select *, case when n%4<2 then 'embed' when n%4=2 then 'audio' else 'legacy' end video_type,
 case when n%8=1 then 1 else n//4 end item from ev""",
    "subtitle_log": f"""select {_ITEM}, video_type, case event_type when 'click' then 'en' when 'view' then 'es' when 'purchase' then 'fr'
  when 'signup' then 'de' else 'pt' end "language", 'C'||item video_cid,'S'||event_id subtitle_cid,
  case when event_id%3<>0 then timestamp'1998-01-01 00:00:00'+to_days(cast(item%1000 as int)) end video_created_at, ts, event_id from ev_item where op<7""",
    "state": """select author,permlink,"language",arg_max(subtitle_cid,ts) subtitle_cid, max(ts) updated_at, min(ts) created_at
  from subtitle_log group by all""",
    "videos": """select author,permlink,first(video_cid order by ts desc) video_cid, first(video_type order by ts) in ('embed','audio') is_embed,
  first(video_type order by ts)='audio' is_audio, min(ts) created_at, max(ts) updated_at,
  first(video_created_at order by ts) video_created_at, count(distinct "language") lang_count from subtitle_log group by author,permlink""",
    "lang_lists": """select author,permlink,string_agg("language",',' order by created_at) languages from state group by all""",
    "queue_log": f"select {_ITEM}, ts requested_at from ev_item where op=7",
    "queue": "select author,permlink,min(requested_at) requested_at from queue_log group by all",
    "run_log": f"""select {_ITEM}, case when n%5=0 then 'queue' else 'batch' end source,
 case event_type when 'error' then 'failed' when 'signup' then 'blacklisted' else 'success' end outcome,
 cast(round(value) as int) processing_seconds, case when n%3=0 then 0 else cast(n%600 as int) end video_duration_seconds, ts from ev_item where op=8""",
    "status_log": f"select {_ITEM}, video_type, case when event_type='error' then 'clear' else 'set' end action, ts from ev_item where op=9",
    "in_work": """select author,permlink,video_type in ('embed','audio') is_embed, video_type='audio' is_audio, ts started_at
  from (select * from status_log order by ts desc limit 1) where action='set'""",
    "tag_log": f"select {_ITEM}, event_type||','||'t'||(cast(floor(value) as bigint)%7) tags, ts from ev_item where op in (3,8)",
    "blacklist": """select 'user'||(case when doc_id%8=0 then 0 else doc_id//8 end) author,'d'||doc_id permlink,
  timestamp'2024-01-01 00:00:00'+to_days(cast(doc_id%300 as int)) added_at from labels where toxic=1""",
    "blacklist_authors": "select 'user'||c_custkey author from customer where c_custkey%11=3",
    "creators": "select 'user'||c_custkey author from customer where c_custkey%9=1",
    "fetch_attempts": """select author,permlink,ord,ok,size_bytes from (select author,permlink,g.ord,
  (cast(substring(permlink,2) as bigint)+g.ord)%3<>0 ok,
 case when cast(substring(permlink,2) as bigint)%10=9 then 0 else 1000+cast(substring(permlink,2) as bigint) end size_bytes
 from catalogs cross join (select 0 ord union all select 1 ord) g)""",
    "media_probe": """select event_id, '{"streams":['||case when event_id%3<>0 then '{"codec_type":"video","codec_name":"h264"}' else '' end||case when event_id%3=1 then ',' else '' end||
 case when event_id%3<>2 then '{"codec_type":"audio","codec_name":"aac"}' else '' end||'],"format":{'||case when event_id%5<>0 then '"duration":"'||event_id||'.5",' else '' end||'"size":"'||(event_id*10)||'"}}' probe from events""",
}


def _needed_by(name: str) -> set[str]:
    text = VIEWS[name]
    direct = {n for n in VIEWS if n != name and re.search(rf"(from|join)\s+{n}\b", text)}
    return direct.union(*[_needed_by(n) for n in direct]) if direct else set()


def with_views(sql: str) -> str:
    """Put the views a query uses in front of it."""
    direct = {n for n in VIEWS if re.search(rf"(from|join)\s+{n}\b", sql)}
    used = direct.union(*[_needed_by(n) for n in direct]) if direct else set()
    ctes = [f"{name} as ({text})" for name, text in VIEWS.items() if name in used]
    if not ctes:
        return sql
    body = sql.lstrip()
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body
