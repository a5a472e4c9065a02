"""Domain tables derived by Spark from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from mediacat.sinks.subtitles import as_state, fold, headers
from mediacat.sources.catalog import everything
from mediacat.sources.tables import spread



def author_of(number: str) -> str:
    """One busy author has every eighth item; each of the others has up to seven."""
    return f"concat('user', case when {number} % 8 = 0 then 0 else {number} div 8 end)"


ITEM_AUTHOR = f"{author_of('item')} author"
ITEM_PERMLINK = (
    "concat(case video_type when 'embed' then 'd' when 'audio' then 'a' else 'v' end, item) permlink"
)


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        return spread(self.table("documents"), self.spark.sparkContext.defaultParallelism, "doc_id")

    @cached_property
    def legacy(self) -> DataFrame:
        return legacy_rows(self.table("orders"))

    @cached_property
    def embed(self) -> DataFrame:
        return embed_rows(self.table("documents"))

    @cached_property
    def audio(self) -> DataFrame:
        return audio_rows(self.table("pages"))

    @cached_property
    def catalogs(self) -> DataFrame:
        return everything(self.legacy, self.embed, self.audio)

    @cached_property
    def raw_segments(self) -> DataFrame:
        """Documents as utterances of 20 timed words."""
        return (
            self.documents
            .selectExpr(
                f"{author_of('doc_id')} author", "concat('d', doc_id) permlink",
                r"filter(split(text, '\\s+'), x -> x <> '') toks",
            )
            .selectExpr(
                "author", "permlink",
                """inline_outer(transform(sequence(0, (size(toks) - 1) div 20), s -> struct(
                     cast(s as bigint) as raw_seg,
                     transform(slice(toks, s * 20 + 1, 20), (t, i) -> struct(
                       concat(' ', t) as word,
                       cast(s * 20 + i as double) * 0.4D as start_s,
                       (cast(s * 20 + i as double) + 1) * 0.4D as end_s)) as words)))""",
            )
            .where("size(words) > 0")
            .selectExpr(
                "author", "permlink", "raw_seg", "element_at(words, 1).start_s start_s",
                "element_at(words, -1).end_s end_s",
                "array_join(transform(words, w -> w.word), '') text", "words",
            )
        )

    @cached_property
    def segments(self) -> DataFrame:
        return self.table("conversations").selectExpr(
            f"{author_of('conv_id')} author", "concat('c', conv_id) permlink", "turn seg_idx",
            "cast(turn as double) * 5 start_s",
            "cast(turn as double) * 5 + least(cast(length(text) as double) / 20, 6) end_s",
            "case when (conv_id + turn) % 23 = 0 then '' else text end text",
        )

    @cached_property
    def events(self) -> DataFrame:
        return items(self.table("events"))

    @cached_property
    def subtitle_log(self) -> DataFrame:
        return subtitle_log_rows(self.events)

    @cached_property
    def state(self) -> DataFrame:
        return fold(as_state(self.subtitle_log))

    @cached_property
    def videos(self) -> DataFrame:
        return headers(self.state)

    @cached_property
    def queue_log(self) -> DataFrame:
        return queue_log_rows(self.events)

    @cached_property
    def queue(self) -> DataFrame:
        """Current queue: the earliest request of each key, never removed here."""
        return self.queue_log.groupBy("author", "permlink").agg({"requested_at": "min"}).withColumnRenamed(
            "min(requested_at)", "requested_at"
        )

    @cached_property
    def run_log(self) -> DataFrame:
        return run_log_rows(self.events)

    @cached_property
    def status_log(self) -> DataFrame:
        return self.events.where("op = 9").selectExpr(
            ITEM_AUTHOR, ITEM_PERMLINK, "video_type",
            "case when event_type = 'error' then 'clear' else 'set' end action", "ts", "event_id",
        )

    @cached_property
    def tag_log(self) -> DataFrame:
        return tag_log_rows(self.events)

    @cached_property
    def blacklist(self) -> DataFrame:
        return self.table("labels").where("toxic = 1").selectExpr(
            f"{author_of('doc_id')} author", "concat('d', doc_id) permlink",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(doc_id % 300 as int)) added_at",
        )

    @cached_property
    def blacklist_authors(self) -> DataFrame:
        return self.table("customer").where("c_custkey % 11 = 3").selectExpr(
            "concat('user', c_custkey) author"
        )

    @cached_property
    def creators(self) -> DataFrame:
        return self.table("customer").where("c_custkey % 9 = 1").selectExpr(
            "concat('user', c_custkey) author"
        )

    @cached_property
    def fetch_attempts(self) -> DataFrame:
        return (
            self.catalogs.selectExpr("author", "permlink", "cast(substring(permlink, 2) as bigint) k",
                                     "explode(array(0, 1)) ord")
            .selectExpr("author", "permlink", "ord", "(k + ord) % 3 <> 0 ok",
                        "case when k % 10 = 9 then 0 else 1000 + k end size_bytes")
        )

    @cached_property
    def media_probe(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            """concat('{"streams":[',
              case when event_id%3<>0 then '{"codec_type":"video","codec_name":"h264"}' else '' end,
              case when event_id%3=1 then ',' else '' end,
              case when event_id%3<>2 then '{"codec_type":"audio","codec_name":"aac"}' else '' end,
              '],"format":{', case when event_id%5<>0 then concat('"duration":"', event_id, '.5",') else '' end,
              '"size":"', event_id*10, '"}}') probe""",
        )


def legacy_rows(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        f"{author_of('o_orderkey')} owner", "concat('v', o_orderkey) permlink",
        """case o_orderkey % 10 when 0 then null when 1 then '' when 2 then concat('http://x/', o_orderkey)
             else concat('ipfs://Qm', o_orderkey) end filename""",
        "case when o_orderkey % 3 = 0 then concat('ipfs://Hl', o_orderkey, '/manifest.m3u8') end video_v2",
        "case o_orderstatus when 'F' then 'published' when 'P' then 'scheduled' else 'draft' end status",
        "case when o_orderstatus = 'P' and o_orderkey % 4 = 0 then null else o_orderdate end created",
        "o_orderdate + make_dt_interval(30) publish_data", "cast(null as string) description",
    )


def embed_rows(documents: DataFrame) -> DataFrame:
    return documents.selectExpr(
        f"{author_of('doc_id')} owner", "concat('d', doc_id) permlink",
        "case when doc_id % 13 = 0 then null when doc_id % 17 = 0 then '' else concat('Em', doc_id) end manifest_cid",
        "case when doc_id % 7 = 0 then 'draft' else 'published' end status",
        "timestamp_ntz'1998-01-01 00:00:00' + make_dt_interval(cast(doc_id % 1000 as int)) createdAt",
        "text description", "lang", "source",
    )


def audio_rows(pages: DataFrame) -> DataFrame:
    return pages.selectExpr(
        f"{author_of('page_id')} owner", "concat('a', page_id) permlink",
        "case when page_id % 11 = 0 then null else concat('Au', page_id) end audio_cid",
        "case when page_id % 7 = 0 then 'draft' else 'published' end status",
        "timestamp_ntz'1999-01-01 00:00:00' + make_dt_interval(cast(page_id % 500 as int)) createdAt",
    )


def items(events: DataFrame) -> DataFrame:
    """Events with an operation code and the item they refer to: one item has an eighth of them, the others grow with the events."""
    return events.selectExpr("*", "event_id % 10 op", "event_id div 10 n").selectExpr(
        "*", "case when n % 4 < 2 then 'embed' when n % 4 = 2 then 'audio' else 'legacy' end video_type",
        "case when n % 8 = 1 then 1 else n div 4 end item",
    )


def subtitle_log_rows(events: DataFrame) -> DataFrame:
    return events.where("op < 7").selectExpr(
        ITEM_AUTHOR, ITEM_PERMLINK, "video_type",
        """case event_type when 'click' then 'en' when 'view' then 'es' when 'purchase' then 'fr'
             when 'signup' then 'de' else 'pt' end language""",
        "concat('C', item) video_cid", "concat('S', event_id) subtitle_cid",
        """case when event_id % 3 <> 0 then
             timestamp_ntz'1998-01-01 00:00:00' + make_dt_interval(cast(item % 1000 as int)) end video_created_at""",
        "ts", "event_id",
    )


def queue_log_rows(events: DataFrame) -> DataFrame:
    return events.where("op = 7").selectExpr(ITEM_AUTHOR, ITEM_PERMLINK, "ts requested_at")


def run_log_rows(events: DataFrame) -> DataFrame:
    return events.where("op = 8").selectExpr(
        ITEM_AUTHOR, ITEM_PERMLINK,
        "case when n % 5 = 0 then 'queue' else 'batch' end source",
        "case event_type when 'error' then 'failed' when 'signup' then 'blacklisted' else 'success' end outcome",
        "cast(round(value) as int) processing_seconds",
        "case when n % 3 = 0 then 0 else cast(n % 600 as int) end video_duration_seconds",
        "ts", "event_id",
    )


def tag_log_rows(events: DataFrame) -> DataFrame:
    return events.where("op in (3, 8)").selectExpr(
        ITEM_AUTHOR, ITEM_PERMLINK,
        "array(event_type, concat('t', cast(floor(value) as bigint) % 7)) tags", "ts", "event_id",
    )
