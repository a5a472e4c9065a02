"""Transcripts and SRT text."""

import uuid

from pyspark.sql import functions as F

from mediacat.functions.timecode import to_millis, to_timecode
from mediacat.operators import srt, transcript
from mediacat.operators.many_rules import corrected_by_many
from mediacat.operators.srt_lines import parse_lines, read_lines
from mediacat.operators.transcript import CUE, cue_block
from mediacat.session import shared_folder
from mediacat.sinks import files
from mediacat.sinks.srt_store import SrtStore
from mediacat.sources.srt_files import read_srt
from mediacat.sources.tables import correction_rules

from . import query
from .inputs import Inputs
from .parameters import CORRECTIONS, MAX_WORDS, SAMPLE_CONVERSATIONS, SAMPLE_DOCUMENTS
from .views import WS, corrections, ms, timecode

KEY = ["author", "permlink"]


def english(segments):
    return segments.withColumn("language", F.lit("en"))


def rendered(t: Inputs):
    return srt.render_documents(english(t.segments))


@query(f"""select author, permlink, raw_seg, word_idx % 20 word_in_seg, word, {ms('start_s')} start_ms, {ms('end_s')} end_ms from words""")
def timed_words(spark, sf_dir):
    words = transcript.words_of(Inputs(spark, sf_dir).raw_segments)
    return words.select(
        *KEY, "raw_seg", F.col("word_in_seg").cast("bigint").alias("word_in_seg"), "word",
        to_millis(F.col("start_s")).alias("start_ms"), to_millis(F.col("end_s")).alias("end_ms"),
    )


@query(f"""select author, permlink, raw_seg, cue_in_seg, {ms('start_s')} start_ms, {ms('end_s')} end_ms, text from cues""")
def split_segments(spark, sf_dir):
    cues = transcript.split_segments(Inputs(spark, sf_dir).raw_segments, MAX_WORDS)
    return cues.select(
        *KEY, "raw_seg", "cue_in_seg",
        to_millis(F.col("start_s")).alias("start_ms"), to_millis(F.col("end_s")).alias("end_ms"), "text",
    )


@query(f"""select author, permlink, raw_seg, w0%20+1 first_word, {ms('start_s')} start_ms, {ms('end_s')} end_ms, text
  from cue_groups where n<=8 or text<>''""")
def split_words(spark, sf_dir):
    """Cues from one row per word."""
    words = transcript.words_of(Inputs(spark, sf_dir).raw_segments).withColumnRenamed("word_in_seg", "word_idx")
    return transcript.split_words(words, MAX_WORDS).select(
        *KEY, "raw_seg", "first_word",
        to_millis(F.col("start_s")).alias("start_ms"), to_millis(F.col("end_s")).alias("end_ms"), "text",
    )


@query("select author, permlink, seg_idx, start_s, end_s, text from cues")
def numbered_cues(spark, sf_dir):
    cues = transcript.split_segments(Inputs(spark, sf_dir).raw_segments, MAX_WORDS)
    return transcript.number_cues(cues)


@query(f"""select author, permlink, seg_idx, {corrections('text')} text from segments""")
def apply_corrections(spark, sf_dir):
    segments = Inputs(spark, sf_dir).segments
    return transcript.apply_corrections(segments, CORRECTIONS).select(*KEY, "seg_idx", "text")


@query("select author, permlink, string_agg(text,' ' order by seg_idx) transcript from segments group by all")
def transcript_text(spark, sf_dir):
    return transcript.transcript_text(Inputs(spark, sf_dir).segments)


@query("""select author, permlink, string_agg(text,' ' order by seg_idx) transcript from segments
  where start_s < 10 group by all""")
def transcript_sample(spark, sf_dir):
    return transcript.transcript_text(Inputs(spark, sf_dir).segments, seconds=SAMPLE_CONVERSATIONS)


@query("""select author, permlink, string_agg(text,' ' order by seg_idx) transcript from cues
  where start_s < 300 group by all""")
def document_sample(spark, sf_dir):
    cues = transcript.split_segments(Inputs(spark, sf_dir).raw_segments, MAX_WORDS)
    return transcript.transcript_text(cues, CUE, cue_block(), SAMPLE_DOCUMENTS)


@query("""select author, permlink, duration_s, duration_min, cast(round_even(duration_s,0) as int) video_duration_seconds
  from seg_durations""")
def video_duration(spark, sf_dir):
    return transcript.video_duration(Inputs(spark, sf_dir).segments)


@query(f"""select author, permlink, word_idx, {timecode('start_s')} start_tc, {timecode('end_s')} end_tc,
   {ms('start_s')} start_ms from words""")
def srt_timestamps(spark, sf_dir):
    words = transcript.words_of(Inputs(spark, sf_dir).raw_segments)
    return words.select(
        *KEY, (F.col("raw_seg") * 20 + F.col("word_in_seg")).alias("word_idx"),
        to_timecode(F.col("start_s")).alias("start_tc"), to_timecode(F.col("end_s")).alias("end_tc"),
        to_millis(F.col("start_s")).alias("start_ms"),
    )


@query("""select author, permlink, "language", author||'/'||permlink||'.'||"language"||'.srt' path, srt, cue_count from rendered""")
def srt_render(spark, sf_dir):
    documents = rendered(Inputs(spark, sf_dir))
    return documents.withColumn("path", srt.subtitle_path())


@query(f"""select author, permlink, 'en' "language", part, string_agg(no||chr(10)||{timecode('start_s')}||' --> '||{timecode('end_s')}
  ||chr(10)||text||chr(10)||chr(10),'' order by no) srt from (select *, row_number() over (partition by author,permlink order by raw_seg,cue_in_seg) no,
  raw_seg//512 part from cues) group by all""")
def srt_parts(spark, sf_dir):
    cues = transcript.split_segments(Inputs(spark, sf_dir).raw_segments, MAX_WORDS)
    return srt.render_parts(english(cues), order=CUE, block=cue_block())


@query(f"""select author, permlink, 'en' "language", row_number() over (partition by author,permlink order by seg_idx)-1 seg_idx,
  {ms('start_s')} start_ms, {ms('end_s')} end_ms, trim(text,{WS}) text from segments""")
def srt_parse(spark, sf_dir):
    cues = srt.parse_documents(rendered(Inputs(spark, sf_dir)))
    return cues.select(*KEY, "language", "seg_idx", "start_ms", "end_ms", "text")


@query(f"""select author, permlink, 'en' "language", count(*) cue_count, count_if(trim(text,{WS})='')::bigint empty_count,
  count_if(coalesce({ms('end_s')} > next_ms, false))::bigint overlap_count, true is_valid from (select *,
  lead({ms('start_s')}) over (partition by author,permlink order by seg_idx) next_ms from segments) group by all""")
def srt_quality(spark, sf_dir):
    return srt.document_quality(rendered(Inputs(spark, sf_dir)))


@query(f"""select author, permlink, seg_idx, next_start_ms, coalesce({ms('end_s')} > next_start_ms, false) is_overlap from (select *,
  lead({ms('start_s')}) over (partition by author,permlink order by seg_idx) next_start_ms from segments)""")
def cue_overlaps(spark, sf_dir):
    rows = srt.overlaps(Inputs(spark, sf_dir).segments, KEY)
    return rows.select(*KEY, "seg_idx", "next_start_ms", "is_overlap")


@query("select author, permlink, sha256(srt) subtitle_cid from rendered")
def subtitle_content_id(spark, sf_dir):
    return srt.with_content_id(rendered(Inputs(spark, sf_dir))).select(*KEY, "subtitle_cid")


@query("""select count(*) n_cues, count(distinct author||'/'||permlink) n_videos, 3 n_corrections from cues""")
def transcript_counts(spark, sf_dir):
    """Cue count of a run and the number of rules applied to it."""
    cues = transcript.split_segments(Inputs(spark, sf_dir).raw_segments, MAX_WORDS)
    per_video = cues.groupBy(*KEY).agg(F.count("*").alias("n"))
    return per_video.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_cues"), F.count("*").alias("n_videos"),
        F.lit(len(CORRECTIONS)).alias("n_corrections"),
    )


@query("""select string_agg(c_mktsegment, ', ' order by c_mktsegment) prompt, count(*) n_words
  from (select distinct c_mktsegment from customer)""")
def hotword_prompt(spark, sf_dir):
    from mediacat.sources.tables import hotword_prompt as prompt

    return prompt(Inputs(spark, sf_dir).table("customer").selectExpr("c_mktsegment word"))


NUMBERED = "lpad(substring(permlink,2),6,'0')"


_WRITTEN: dict[tuple[str, str], str] = {}


def other_line_ends(t: Inputs):
    """The rendered documents under numeric-looking names, some with other line ends, a byte order mark or a note before the cues."""
    name = F.lpad(F.substring("permlink", 2, 20), 6, "0")
    number = name.cast("int") % 4
    text = (
        F.when(number == 1, F.replace("srt", F.lit("\n"), F.lit("\r\n")))
        .when(number == 2, F.concat(F.lit("\ufeff"), "srt")).when(number == 3, F.concat(F.lit("note\n\n"), "srt")).otherwise(F.col("srt"))
    )
    return rendered(t).select("author", name.alias("permlink"), "language", text.alias("srt"))


def files_folder(t: Inputs) -> str:
    """The documents written as a file each, once in a session."""
    key = t.spark.sparkContext.applicationId, t.sf_dir
    if key not in _WRITTEN:
        folder = f"{shared_folder(t.spark)}/srt-{uuid.uuid4().hex}"
        files.write_srt(other_line_ends(t), folder)
        _WRITTEN[key] = folder
    return _WRITTEN[key]


def written_files(t: Inputs):
    return read_srt(t.spark, files_folder(t))


@query(f"""select author, {NUMBERED} permlink, "language", cue_count, octet_length(encode(srt)) + case {NUMBERED}::int%4
  when 1 then length(srt)-length(replace(srt,chr(10),'')) when 2 then 3 when 3 then 6 else 0 end n_bytes from rendered""")
def srt_file_round_trip(spark, sf_dir):
    """Files with numeric-looking names and every kind of line end come back with all their cues."""
    found = written_files(Inputs(spark, sf_dir))
    sizes = found.select(*srt.DOCUMENT, F.octet_length("srt").cast("long").alias("n_bytes"))
    return srt.document_quality(found).select(*srt.DOCUMENT, "cue_count").join(sizes, srt.DOCUMENT)


@query(f"""select author, {NUMBERED} permlink, "language", 0 "at", 'note' piece from rendered where {NUMBERED}::int%4=3""")
def srt_unparsed(spark, sf_dir):
    return srt.unparsed(written_files(Inputs(spark, sf_dir)))


@query(f"""select author, {NUMBERED} permlink, 'en' "language", no cue_no, {ms('start_s')} start_ms, {ms('end_s')} end_ms, trim(text,{WS}) text
  from (select *, row_number() over (partition by author,permlink order by seg_idx) no from segments)""")
def srt_file_cues(spark, sf_dir):
    """Cues of the same files, read line by line in byte ranges: no file is one value."""
    cues = parse_lines(read_lines(spark, files_folder(Inputs(spark, sf_dir))))
    return cues.select(*srt.DOCUMENT, "cue_no", "start_ms", "end_ms", "text")


@query(f"""select author, {NUMBERED} permlink, "language", case {NUMBERED}::int%4 when 1 then sha256(replace(srt,chr(10),chr(13)||chr(10)))
  when 2 then sha256(chr(65279)||srt) when 3 then sha256('note'||chr(10)||chr(10)||srt) else sha256(srt) end subtitle_cid from rendered""")
def srt_store_round_trip(spark, sf_dir):
    """The same texts through the packed store: exact bytes back."""
    t = Inputs(spark, sf_dir)
    store = SrtStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    store.write(other_line_ends(t))
    return srt.with_content_id(store.documents()).select(*srt.DOCUMENT, "subtitle_cid")


@query(f"""select author, permlink, 'en' "language", sha256(srt) subtitle_cid, octet_length(encode(srt)) n_bytes, n_parts from (select author, permlink,
  string_agg(no||chr(10)||{timecode('start_s')}||' --> '||{timecode('end_s')}||chr(10)||text||chr(10)||chr(10),'' order by no) srt, count(distinct raw_seg//512) n_parts
  from (select *, row_number() over (partition by author,permlink order by raw_seg,cue_in_seg) no from cues) group by all)""")
def srt_part_ids(spark, sf_dir):
    """Content ids over the pieces of texts that are never put together."""
    cues = transcript.split_segments(Inputs(spark, sf_dir).raw_segments, MAX_WORDS)
    return srt.content_ids(srt.render_parts(english(cues), order=CUE, block=cue_block()))


@query(f"""select author, permlink, 'en' "language", count_if(not broken)::bigint cue_count, count_if(not broken and trim(text,{WS})='')::bigint empty_count,
  count_if(not broken and coalesce({ms('end_s')} > next_ms, false))::bigint overlap_count, not bool_or(broken) is_valid from (select *,
  lead({ms('start_s')}) over (partition by author,permlink order by seg_idx) next_ms, {NUMBERED}::int%3=0 broken from segments) group by author, permlink""")
def srt_quality_broken(spark, sf_dir):
    """Quality of files of which a third have lost the arrows of their timing lines: those have no cue and are not valid."""
    documents = rendered(Inputs(spark, sf_dir))
    broken = F.substring("permlink", 2, 20).cast("int") % 3 == 0
    return srt.document_quality(documents.withColumn("srt", F.when(broken, F.replace("srt", F.lit(" --> "), F.lit(" "))).otherwise(F.col("srt"))))


@query(f"""select author, permlink, seg_idx, {corrections('text')} text from segments""")
def corrections_from_table(spark, sf_dir):
    """A long rule list from a table, most of which no text has, and the configured rules after it: one automaton, one column."""
    t = Inputs(spark, sf_dir)
    listed = t.table("supplier").selectExpr("cast(s_suppkey as int) ord", "concat(s_name, '#') from_text", "cast(s_acctbal as string) to_text")
    last = spark.createDataFrame([((1 << 30) + i, *rule) for i, rule in enumerate(CORRECTIONS)], "ord int, from_text string, to_text string")
    rules = correction_rules(listed.unionByName(last))
    return t.segments.select(*KEY, "seg_idx", corrected_by_many("text", rules).alias("text"))
