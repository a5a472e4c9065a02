"""Fill-in-middle transformation of whole texts, checked by an exact way back.

A text is cut into lines; two hashed draws give where its prefix and its middle end. Pieces
of at most ``CHUNK`` bytes are emitted with the number of their row and their place in the
output. One shuffle brings a row's pieces together and sorts them; they stream through an
incremental digest, so no task holds a whole output. What has streamed is read as the output
it is: its marks tell the sections, and the same tasks sort the pieces again by section and
place, which restores the text for a second digest. No further shuffle is needed, and the
sorts spill to disk where a text is larger than memory.

Defined cases: a null text is empty, and an empty text is plain. A null id draws from the
hash of ``7:`` alone. Rows are told apart by number, so repeated rows come out once each.
Input columns other than the two named ones play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import text_slices

CHUNK = 64 << 10
RATE, SPM_SHARE = 100, 50

# The marks, and what is hashed before an id.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SALT = "7:"

PIECES = "row long, part long, place long, piece binary, doc_id long, n long, form string, prefix_chars long, middle_chars long"
STREAMED = PIECES + ", output_sha256 string"
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
u as (select doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as units, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
c as (select *, len(units) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as lo, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as hi,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
         when h4 % 100 < 50 then 'spm' else 'psm' end as form from u),
s as (select *, array_to_string(units[1:lo], '') as p, array_to_string(units[lo + 1:hi], '') as m, array_to_string(units[hi + 1:], '') as s from c)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256 from s"""


def characters(data: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def cut(text: bytes, doc_id: int | None, rate: int = RATE, spm_share: int = SPM_SHARE) -> tuple[int, str, list[bytes], tuple | None]:
    """Lines, form, the output's parts in order, and the characters of prefix and middle."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    n = len(ends) + (len(text) > (int(ends[-1]) if len(ends) else 0))
    drawn = hashlib.sha256(f"{SALT}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return n, "plain", [text], None
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    bounds = [0 if k == 0 else len(text) if k == n else int(ends[k - 1]) for k in (low, high)]
    prefix, middle, suffix = text[: bounds[0]], text[bounds[0] : bounds[1]], text[bounds[1] :]
    sizes = characters(prefix), characters(middle)
    if h[3] % 100 < spm_share:
        return n, "spm", [SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle], sizes
    return n, "psm", [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle], sizes


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE, spm_share: int = SPM_SHARE,
           chunk: int = CHUNK) -> DataFrame:
    """The outputs of all rows in pieces (``PIECES``); ``part`` and ``place`` order them, the first tells the row's facts.

    A mark is a piece of its own, and no other piece equals one: a text that holds a mark is plain.
    """
    chunk = max(chunk, len(PREFIX))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, "text", 8 << 20):
                out: list[tuple] = []
                held = 0
                for row, name, whole in zip(*(rows.column(i).to_pylist() for i in range(3))):
                    n, form, parts, sizes = cut((whole or "").encode(), name, rate, spm_share)
                    facts = (name, n, form, *(sizes or (None, None)))
                    for part, data in enumerate(parts):
                        for place in range(0, max(1, len(data)), chunk):
                            out.append((row, part, place, data[place : place + chunk], *facts))
                            facts = (None,) * 5
                            held += chunk if len(data) > place + chunk else len(data) - place
                            if held > 32 << 20:
                                yield batch_of(out, PIECES)
                                out, held = [], 0
                if out:
                    yield batch_of(out, PIECES)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, PIECES)


def batch_of(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)], [name for name, _ in fields])


def section(mark: bytes) -> int:
    """Where the section after a mark stands in the text."""
    return (PREFIX, MIDDLE, SUFFIX).index(mark)


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted output pieces through a digest. They come out with the section that the marks
    before them tell as ``part``; the row's facts and digest follow as part 3."""
    row, sha, facts, at = None, None, None, 0
    for batch in batches:
        out: list[tuple] = []
        for number, _, place, piece, *told in zip(*(c.to_pylist() for c in batch.columns)):
            if number != row:
                if row is not None:
                    out.append((row, 3, 0, b"", *facts, sha.hexdigest()))
                row, sha, facts, at = number, hashlib.sha256(), told, 0
            sha.update(piece)
            if facts[2] != "plain" and piece in (PREFIX, SUFFIX, MIDDLE):
                at = section(piece)
            elif piece:
                out.append((row, at, place, piece, None, None, None, None, None, None))
        if out:
            yield batch_of(out, STREAMED)
    if row is not None:
        yield batch_of([(row, 3, 0, b"", *facts, sha.hexdigest())], STREAMED)


def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of the text through a second digest; one result row for each text."""
    sha = hashlib.sha256()
    for batch in batches:
        out: list[tuple] = []
        for part, piece, *told in zip(*(batch.column(i).to_pylist() for i in (1, 3, 4, 5, 6, 7, 8, 9))):
            if part < 3:
                sha.update(piece)
            else:
                out.append((*told, sha.hexdigest()))
                sha = hashlib.sha256()
        if out:
            yield batch_of(out, RESULT)


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE, spm_share: int = SPM_SHARE,
              chunk: int = CHUNK) -> DataFrame:
    """Digest of each row's output and of the text restored from it (``RESULT``)."""
    placed = pieces(docs, doc_id, text, rate, spm_share, chunk).repartition(F.col("row"))
    back = placed.sortWithinPartitions("row", "part", "place").mapInArrow(streamed, STREAMED)
    return back.sortWithinPartitions("row", "part", "place").mapInArrow(restored, RESULT)


def outputs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """The rows of ``docs`` with their training text in place of ``text``, for texts that fit a row."""
    names, kind = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, text, 8 << 20):
                ids, texts = (rows.column(names.index(c)).to_pylist() for c in (doc_id, text))
                made = [b"".join(cut((t or "").encode(), i, rate, spm_share)[2]).decode() for i, t in zip(ids, texts)]
                columns = [pa.array(made, c.type) if name == text else c for name, c in zip(names, rows.columns)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, kind)
