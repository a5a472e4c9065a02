"""Topic tags."""

from pyspark.sql import functions as F

from mediacat.functions.fixed_values import SCORE_MAP_CHARS
from mediacat.operators import tagging, transcript
from mediacat.operators.transcript import CUE, cue_block

from . import query
from .inputs import Inputs
from .parameters import MAX_TAGS, MAX_WORDS, MIN_CONFIDENCE, SAMPLE_DOCUMENTS, TAGS
from .views import WS

KEY = ["author", "permlink"]
TEXT = f"""(select e.owner author, e.permlink, doc_id, case when d='' and t='' then null when d='' then transcript
  when t='' then substring(description,1,3000) else substring(description,1,1500)||chr(10)||chr(10)||transcript end tag_text from
  (select *, cast(substring(permlink,2) as bigint) doc_id, trim(coalesce(description,''),{WS}) d, trim(coalesce(transcript,''),{WS}) t from
   (select owner, permlink, case when cast(substring(permlink,2) as bigint)%4=0 then null when cast(substring(permlink,2) as bigint)%4=1 then '  ' else description end description
     from catalog_embed) left join (select author, permlink p, string_agg(text,' ' order by seg_idx) transcript from cues where start_s<300
     and cast(substring(permlink,2) as bigint)%8>1 group by all) s on owner=s.author and permlink=s.p) e)"""
SCORES = r"""(select doc_id, ord, label, cast(len(list_filter(toks, lambda x: x=seed)) as double)/greatest(len(toks),1) score from
  (select doc_id, list_filter(regexp_split_to_array({text},'\s+'), lambda x: x<>'') toks from {rows}) cross join tag_seeds)"""
TAGGED = f"""(select author, permlink, t.doc_id, tag_text is null no_text, tags from {TEXT} t left join (select doc_id, string_agg(label,',' order by score desc,label) tags from (select *,
  row_number() over (partition by doc_id order by score desc, label) r from {SCORES.format(text='tag_text', rows='(select * from ' + TEXT + ' where tag_text is not null)')})
  where (score>=0.02 and r<=2) or r=1 group by doc_id) s on t.doc_id=s.doc_id)"""


def seed_shares(texts, labels):
    """A stand-in scorer: the share of a text's words that equal the seed of each label."""
    seeds = {tag.label: tag.seed for tag in TAGS}
    found = []
    for text in texts:
        tokens = text.split()
        found.append([tokens.count(seeds[label]) / max(len(tokens), 1) for label in labels])
    return found


def tag_texts(t: Inputs):
    """Embed rows with description and sampled speech; some have one of them, some neither."""
    k = "cast(substring(permlink, 2) as bigint)"
    about = t.embed.selectExpr(
        "owner author", "permlink",
        f"case {k} % 4 when 0 then null when 1 then '  ' else description end description",
    )
    cues = transcript.split_segments(t.raw_segments, MAX_WORDS).where(f"{k} % 8 > 1")
    speech = transcript.transcript_text(cues, CUE, cue_block(), SAMPLE_DOCUMENTS)
    return tagging.classification_text(about.join(speech, KEY, "left"))


def scored(t: Inputs):
    return tagging.with_seed_scores(tag_texts(t), TAGS)


def tagged(t: Inputs):
    return tagging.select_tags(scored(t), MAX_TAGS, MIN_CONFIDENCE)


@query(f"select author, permlink, tag_text from {TEXT}")
def tag_input_text(spark, sf_dir):
    return tag_texts(Inputs(spark, sf_dir)).select(*KEY, "tag_text")


@query(f"select doc_id, label, score from {SCORES.format(text='text', rows='documents')}")
def tag_scores(spark, sf_dir):
    rows = tagging.with_seed_scores(Inputs(spark, sf_dir).documents.select("doc_id", "text"), TAGS, "text")
    return rows.select("doc_id", F.explode_outer("scores").alias("s")).select("doc_id", "s.label", "s.score")


@query(f"""select doc_id, max(score) filter (label='food') food, max(score) filter (label='travel') travel, max(score) filter (label='vlog') vlog,
  max(score) filter (label='music') music, max(score) filter (label='news') news, max(score) filter (label='science') science
  from {SCORES.format(text='text', rows="(select doc_id, substring(text,1,3000) text from documents)")} group by doc_id""")
def tag_score_map(spark, sf_dir):
    """All scores of a transcript as one map (shown as columns)."""
    start = F.substring("text", 1, SCORE_MAP_CHARS).alias("start")
    rows = tagging.with_seed_scores(Inputs(spark, sf_dir).documents.select("doc_id", start), TAGS, "start")
    return rows.select("doc_id", tagging.score_map("scores").alias("m")).select("doc_id", *[F.try_element_at("m", F.lit(tag.label)).alias(tag.label) for tag in TAGS])


@query(f"""select author, permlink, case when no_text then 'no_text' else 'scored' end reason,
  case when no_text then 'vlog,general' else tags end tags from {TAGGED}""")
def select_tags(spark, sf_dir):
    return tagged(Inputs(spark, sf_dir)).select(*KEY, "reason", F.array_join("tags", ",").alias("tags"))


@query(f"""select author, permlink, case when tag_text is null then 'no_text' when length(tag_text)%3=0 then 'failed' else 'scored' end reason,
  case when tag_text is null then 'vlog,general' when length(tag_text)%3=0 then 'general,video' else tags end tags
  from {TEXT} x join (select author, permlink, tags from {TAGGED}) y using (author, permlink)""")
def failed_tags(spark, sf_dir):
    """A scorer that raises for some texts: only these get the tags of a failure."""
    def choosy(texts, labels):
        if any(len(text) % 3 == 0 for text in texts):
            raise ValueError("no answer")
        return seed_shares(texts, labels)

    texts = tag_texts(Inputs(spark, sf_dir)).select(*KEY, "tag_text")
    rows = tagging.scored_by_hook(texts, choosy, [tag.label for tag in TAGS])
    found = tagging.select_tags(rows, MAX_TAGS, MIN_CONFIDENCE)
    return found.select(*KEY, "reason", F.array_join("tags", ",").alias("tags"))


@query(f"""select author, permlink, array_to_string(list_concat(tags, list_filter(custom, lambda x: not list_contains(tags,x))[1:greatest(0,4-len(tags))]),',') tags
  from (select author, permlink, string_split(case when no_text then 'vlog,general' else tags end,',') tags, [lang, source, 'vlog'] custom
  from {TAGGED} t join documents d on d.doc_id=t.doc_id)""")
def add_custom_tags(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    custom = t.embed.select(
        F.col("owner").alias("author"), "permlink", F.array("lang", "source", F.lit("vlog")).alias("custom")
    )
    rows = tagging.add_custom_tags(tagged(t).join(custom, KEY), "custom", MAX_TAGS)
    return rows.select(*KEY, F.array_join("tags", ",").alias("tags"))


@query("""select author, permlink, arg_max(tags,ts) tags, max(ts) created_at from tag_log group by all""")
def tags_csv(spark, sf_dir):
    from mediacat.sinks.subtitles import fold_tags

    return fold_tags(Inputs(spark, sf_dir).tag_log)


@query(f"select doc_id, label, score from {SCORES.format(text='text', rows='documents')}")
def tag_scores_hook(spark, sf_dir):
    """The same scores through the user's scorer hook (Arrow batches)."""
    rows = Inputs(spark, sf_dir).documents.select("doc_id", "text")
    found = tagging.scored_by_hook(rows, seed_shares, [tag.label for tag in TAGS], text="text")
    return found.select("doc_id", F.explode("scores").alias("s")).select("doc_id", "s.label", "s.score")


@query(f"""select author, permlink, case when trim(said,{WS})='' then null else said end tag_text from (select author, permlink,
  substring(string_agg(text,' ' order by seg_idx),1,1500) said from cues group by all)""")
def tag_input_unsampled(spark, sf_dir):
    """All of the speech, shortened by definition, and no description."""
    t = Inputs(spark, sf_dir)
    speech = transcript.transcript_text(transcript.split_segments(t.raw_segments, MAX_WORDS), CUE, cue_block())
    rows = tagging.classification_text(speech.withColumn("description", F.lit(None).cast("string")), sampled=False)
    return rows.select(*KEY, "tag_text")
