"""Removal of lines that many sites share, with DataFrame functions only.

The spread of a line is its number of distinct sites. A HyperLogLog sketch of the sites is
kept for each line hash and merged by aggregation. Lines whose estimate is near ``min_sites`` get
an exact distinct count; for the others the sketch decides. A line that reaches ``min_sites``
is boilerplate: it stays where it first occurs (smallest id, then line number) and goes
everywhere else.

A line is compared without blanks, tabs and carriage returns at its ends. Blank lines are
never boilerplate. The text that stays is joined again by line breaks, otherwise unchanged.

Defined cases: a null text stays null and has no lines; an empty one has one blank line.
A null site counts as the empty one. Rows without an id are counted, but keep all their
lines. Repeated rows of one id and text lose the same lines. An empty table gives an empty
result. Input columns with the name of a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

MIN_SITES = 16
SKETCH_BITS = 10
# Four standard errors of a sketch with 2 ** SKETCH_BITS registers.
BAND = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)


def trimmed(line):
    return F.btrim(line, F.lit(" \t\r"))


def line_keys(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """A row for each line that is not blank: its hashes, number, site and the row it is from."""
    rows = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_key"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(text, "\n")).alias("at", "line"),
    ).withColumn("line", trimmed("line")).where("line <> ''")
    return rows.select("id", "text_key", "site", "at", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))


def spread_lines(keys: DataFrame, min_sites: int) -> DataFrame:
    """(h1, h2) of the lines with at least ``min_sites`` distinct sites."""
    sketched = stored(
        keys.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"))
        .select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites * (1 - BAND) - 1))
    sure = F.col("sites") > min_sites * (1 + BAND) + 1
    near = sketched.where(~sure).select("h1", "h2")
    exact = (keys.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2")
             .agg(F.count_distinct("site").alias("sites")).where(F.col("sites") >= min_sites))
    return sketched.where(sure).select("h1", "h2").union(exact.select("h1", "h2"))


def without_shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                         min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the text that stays, ``n_lines`` and ``n_removed``."""
    keys = stored(line_keys(docs, doc_id, text, site))
    shared = keys.where("id is not null").join(spread_lines(keys, min_sites), ["h1", "h2"], "left_semi")
    shared = stored(shared.select("h1", "h2", "id", "text_key", "at"))
    first = shared.groupBy("h1", "h2").agg(F.min(F.struct("id", "at")).alias("first"))
    gone = (shared.join(first, ["h1", "h2"]).where("id <> first.id or at <> first.at")
            .groupBy("id", "text_key").agg(F.collect_set("at").alias("gone")))
    kept = docs.drop("n_lines", "n_removed")
    joined = kept.join(
        gone.select(F.col("id").alias("__id"), F.col("text_key").alias("__key"), F.col("gone").alias("__gone")),
        (F.col(doc_id) == F.col("__id")) & (F.xxhash64(text) == F.col("__key")), "left")
    lines = F.split(text, "\n")
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    new = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n"))
    n_lines = F.coalesce(F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    return joined.select(
        *[(new if c == text else F.col(f"`{c}`")).alias(c) for c in kept.columns],
        n_lines.alias("n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


SQL = f"""
with lines as (
    select doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(13)) as k from (
        select doc_id, source, unnest(string_split(text, chr(10))) as line,
            generate_subscripts(string_split(text, chr(10)), 1) as pos
        from documents)),
shared as (
    select k from lines where k <> '' group by k having count(distinct coalesce(source, '')) >= {MIN_SITES}),
numbered as (
    select k, doc_id, pos, row_number() over (partition by k order by doc_id, pos) as n
    from lines where k in (select k from shared)),
gone as (select doc_id, pos from numbered where n > 1),
rest as (
    select l.doc_id, count(*) as n_lines, count(g.pos) as n_removed,
        coalesce(string_agg(line, chr(10) order by l.pos) filter (where g.pos is null), '') as text
    from lines l left join gone g on l.doc_id = g.doc_id and l.pos = g.pos group by l.doc_id)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, md5(r.text) as text_md5
from documents d left join rest r using (doc_id)
"""
