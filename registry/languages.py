"""Language rules, fan-out and translation."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from mediacat.operators import languages as L
from mediacat.operators import transcript, translation
from mediacat.operators.translation_memory import TranslationMemory
from mediacat.plans import work_pass
from mediacat.session import shared_folder
from mediacat.sinks.srt_store import SrtStore
from mediacat.sources import config

from . import query
from .inputs import Inputs
from .parameters import (
    CORRECTIONS, FEW_LANGUAGES, LANGUAGES, MAX_WORDS, NOW, stand_in_translation,
)
from .views import WS, corrections, timecode

KEY = ["author", "permlink"]
CODES = """case "language" when 'en' then 'eng_Latn' when 'es' then 'spa_Latn' when 'fr' then 'fra_Latn'
 when 'de' then 'deu_Latn' when 'pt' then 'por_Latn' else 'eng_Latn' end"""
ELIGIBLE = 'coalesce(max_duration,0)=0 or duration_min<=max_duration'
# Segments of the conversations over their eligible languages, spoken language "en".
FANNED = f"""(select s.*, l.code "language" from segments s join seg_durations d on s.author=d.author and s.permlink=d.permlink
  join languages l on {ELIGIBLE})"""


def document_durations(t: Inputs):
    cues = transcript.split_segments(t.raw_segments, MAX_WORDS)
    return transcript.video_duration(cues, transcript.cue_rank())


def fanned(t: Inputs):
    targets = L.eligible_languages(transcript.video_duration(t.segments), LANGUAGES)
    return L.fan_out(t.segments, targets).withColumn("source_language", F.lit("en"))


@query(f"""select author, permlink, ord, code "language" from durations join languages on {ELIGIBLE}""")
def eligible_languages(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return L.eligible_languages(document_durations(t), LANGUAGES).drop("duration_min")


@query(f"""select author, permlink, count_if(not ({ELIGIBLE}))::bigint n_skipped from durations cross join languages group by all""")
def skipped_languages(spark, sf_dir):
    return L.skipped_languages(document_durations(Inputs(spark, sf_dir)), LANGUAGES)


@query("""select author, permlink from state where "language" in ('en','es','fr') group by all having count(distinct "language")=3""")
def videos_fully_done(spark, sf_dir):
    return L.fully_done(Inputs(spark, sf_dir).state, FEW_LANGUAGES)


@query("""select author, permlink, languages from lang_lists""")
def existing_languages(spark, sf_dir):
    videos = Inputs(spark, sf_dir).videos
    return videos.select(*KEY, F.array_join("languages", ",").alias("languages"))


@query(f"""select d.author, d.permlink, ord, code "language" from durations d join languages on {ELIGIBLE}
  where not exists (select 1 from state s where s.author=d.author and s.permlink=d.permlink and s."language"=code)""")
def remaining_languages(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    return L.remaining_languages(document_durations(t), LANGUAGES, t.state).drop("duration_min")


@query(f"""select author, permlink, seg_idx, "language", text from {FANNED}""")
def language_fanout(spark, sf_dir):
    return fanned(Inputs(spark, sf_dir)).select(*KEY, "seg_idx", "language", "text")


@query(f"""select doc_id, "language", {CODES} language_code, "language" in ('en','es','fr','de','pt') language_is_mapped from
  (select doc_id, case when doc_id%9=0 then 'xx' when doc_id%9=1 then 'pt' else lang end "language" from documents)""")
def language_code_map(spark, sf_dir):
    rows = Inputs(spark, sf_dir).table("documents").selectExpr(
        "doc_id", "case doc_id % 9 when 0 then 'xx' when 1 then 'pt' else lang end language"
    )
    return L.with_script_codes(rows, "language", "language")


@query("""select doc_id, lang, case when lang in ('en','es','fr') then lang else 'en' end source_language from documents""")
def detected_language_fallback(spark, sf_dir):
    rows = Inputs(spark, sf_dir).table("documents").select("doc_id", "lang")
    return L.detected_language(rows, FEW_LANGUAGES)


@query(f"""select author, permlink, seg_idx, "language", start_s, end_s,
  case when "language"='en' then text else '[eng_Latn>'||{CODES}||'] '||text end text from {FANNED}""")
def translate_segments(spark, sf_dir):
    done = translation.translate_segments(fanned(Inputs(spark, sf_dir)), stand_in_translation)
    return done.select(*KEY, "seg_idx", "language", "start_s", "end_s", "text")


@query(f"""select author, permlink, seg_idx, "language", start_s, end_s,
  case when "language"='en' then text else '[eng_Latn>'||{CODES}||'] '||text end text from {FANNED}""")
def translate_remembered(spark, sf_dir):
    """A second pass, over all languages, with the translations a first one for Spanish has left."""
    segments = fanned(Inputs(spark, sf_dir))
    memory = TranslationMemory(spark, f"{shared_folder(spark)}/units-{uuid.uuid4().hex}")
    memory.translate(segments.where("language = 'es'"), stand_in_translation)
    done = translation.with_translations(segments, memory.translate(segments, stand_in_translation))
    return done.select(*KEY, "seg_idx", "language", "start_s", "end_s", "text")


@query("""select row_number() over (order by lang) - 1 ord, lang code, cast(null as double) max_duration, n from (select lang, count(*) n from documents group by lang)""")
def configured_languages(spark, sf_dir):
    """A configuration whose languages are those of the documents, as a table a job can join."""
    documents = Inputs(spark, sf_dir).table("documents")
    found = sorted(r["lang"] for r in documents.select("lang").distinct().collect())
    settings = config.from_mapping({"languages": [{"code": code} for code in found]})
    counts = documents.groupBy(F.col("lang").alias("code")).agg(F.count("*").alias("n"))
    return config.languages_table(spark, settings).join(counts, "code").select("ord", "code", "max_duration", "n")


@query(f"""select author, permlink, "language", count(*) n_segments from {FANNED} group by all having count_if("language"='fr' and length(text)%7=3)>0""")
def translation_rejects(spark, sf_dir):
    """A model that fails on some texts of one language rejects these documents only."""
    def choosy(texts, source, target):
        if target == "fra_Latn" and any(len(text) % 7 == 3 for text in texts):
            raise ValueError("no answer")
        return stand_in_translation(texts, source, target)

    rows = fanned(Inputs(spark, sf_dir))
    failed = translation.rejects(rows, translation.stored_translations(rows, choosy))
    return rows.join(failed, [*KEY, "language"]).groupBy(*KEY, "language").agg(F.count("*").alias("n_segments"))


GAPS = "substring(permlink,2)::bigint % 7 <> 0 or seg_idx % 3 <> 1"


@query(f"""select author, permlink, "language", count(*) n_segments, count_if({GAPS})::bigint n_translations
  from {FANNED} group by all having count(*)<>count_if({GAPS})""")
def translation_count_mismatch(spark, sf_dir):
    segments = fanned(Inputs(spark, sf_dir))
    with_gaps = segments.where("cast(substring(permlink, 2) as bigint) % 7 <> 0 or seg_idx % 3 <> 1")
    return translation.mismatched(segments, with_gaps, [*KEY, "language"])


@query(f"""select author, permlink, seg_idx, "language", start_s, end_s, 'T '||text text from {FANNED}
  where (author, permlink, "language") in (select (author, permlink, "language") from {FANNED} group by author, permlink, "language"
    having count(*)=count_if({GAPS}))""")
def translation_pairs(spark, sf_dir):
    """Original times with translated texts where the counts agree."""
    segments = fanned(Inputs(spark, sf_dir))
    texts = segments.where("cast(substring(permlink, 2) as bigint) % 7 <> 0 or seg_idx % 3 <> 1").select(
        *KEY, "language", "seg_idx", F.concat(F.lit("T "), "text").alias("text")
    )
    return translation.pair_by_position(segments, texts, [*KEY, "language"]).select(
        *KEY, "seg_idx", "language", "start_s", "end_s", "text"
    )


def pass_videos(t: Inputs):
    videos = work_pass.open_videos(
        t.legacy, t.embed, t.audio, t.blacklist_authors, t.blacklist, NOW, datetime(1998, 6, 1)
    )
    spoken = L.detected_language(t.embed.selectExpr("owner author", "permlink", "lang"), FEW_LANGUAGES)
    return videos.where(F.col("video_type") == "embed").join(spoken, KEY)


def pass_documents(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    videos = pass_videos(t)
    documents = work_pass.subtitle_documents(
        videos, t.raw_segments, t.state, LANGUAGES, CORRECTIONS, stand_in_translation, MAX_WORDS
    )
    return videos, documents


PASS = f"""select author, permlink, "language", cid video_cid, created_at video_created_at, string_agg((seg_idx+1)||chr(10)||{timecode('start_s')}||' --> '||{timecode('end_s')}
   ||chr(10)||trim(case when src="language" then text else '['||src_code||'>'||{CODES}||'] '||text end,{WS})||chr(10)||chr(10),'' order by seg_idx) srt, count(*) cue_count
 from (select c.author, c.permlink, seg_idx, start_s, end_s, {corrections('c.text')} text, code "language", v.manifest_cid cid, v.created_at, src,
   case src when 'en' then 'eng_Latn' when 'es' then 'spa_Latn' when 'fr' then 'fra_Latn' end src_code
  from cues c join durations d on c.author=d.author and c.permlink=d.permlink join languages l on {ELIGIBLE}
  join (select a.*, case when e.lang in ('en','es','fr') then e.lang else 'en' end src from available_embed a join catalog_embed e
    on a.author=e.owner and a.permlink=e.permlink) v on c.author=v.author and c.permlink=v.permlink
  where not exists (select 1 from state s where s.author=c.author and s.permlink=c.permlink and s."language"=code)) group by all"""
OPEN_EMBED = """available_embed as (select * from candidates c where video_type='embed' and created_at>=timestamp'1998-06-01'
  and author not in (select author from blacklist_authors)
  and not exists (select 1 from blacklist b where b.author=c.author and b.permlink=c.permlink))"""


@query(f"""with {OPEN_EMBED} select author, permlink, "language", cue_count, sha256(srt) subtitle_cid,
  author||'/'||permlink||'.'||"language"||'.srt' path from ({PASS})""")
def work_pass_documents(spark, sf_dir):
    """A whole pass: choice of work, cues, corrections, languages, translation hook, SRT, ids."""
    return pass_documents(spark, sf_dir)[1].drop("srt")


@query(f"""with {OPEN_EMBED} select author, permlink, "language", sha256(srt) subtitle_cid, 'embed' video_type, video_cid,
  video_created_at from ({PASS})""")
def work_pass_saves(spark, sf_dir):
    videos, documents = pass_documents(spark, sf_dir)
    return work_pass.saves(documents, videos)


@query(f"""with {OPEN_EMBED} select author, permlink, "language", sha256(srt) subtitle_cid, octet_length(encode(srt)) n_bytes,
  author||'/'||permlink||'.'||"language"||'.srt' path from ({PASS})""")
def work_pass_parts(spark, sf_dir):
    """The same pass with its texts in pieces in the packed store; ids are taken over the pieces."""
    t = Inputs(spark, sf_dir)
    videos = pass_videos(t)
    store = SrtStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    made = work_pass.run_pass_into(
        store, videos, t.raw_segments, t.state, LANGUAGES, CORRECTIONS, stand_in_translation, MAX_WORDS)
    return made.documents.drop("n_parts")
