r"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of two neighbouring lines chooses the chunk
boundaries: a chunk ends where it begins to fall. That depends on the last four
lines only, so an insertion shifts boundaries only next to itself, and as no
two neighbours both begin a fall, every chunk of a text of two or more lines
has two or more. Those that occur more than once in the corpus are removed but
for their first occurrence, in the order of (doc_id, place). Hashes only pick
candidates; what is removed was grouped by its bytes. Only DataFrame functions
are used.

Inside this module a chunk is encoded: each line gets a leading space, lines
are joined by one line feed and chunks by two. No encoded line is empty, so the
two separators cannot be mistaken whatever the text holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_checked, free_names, keep_ids, land

#: The rolling hash is (FACTOR * hash of the line before + hash of the line) mod PRIME, of 32-bit line hashes.
FACTOR, PRIME = 31, 4_294_967_291


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def _shifted(first: Column, values: Column) -> Column:
    return F.concat(F.array(first), F.slice(values, 1, F.size(values) - 1))


def _ends(hashed: Column) -> Column:
    """Whether a chunk ends with each line, by the lines' hashes; the last line may say either."""
    rolled = F.zip_with(_shifted(F.lit(0).cast("long"), hashed), hashed, lambda a, b: F.pmod(a * FACTOR + b, F.lit(PRIME)))
    falls = _let(rolled, lambda r: F.zip_with(_shifted(F.lit(-1).cast("long"), r), r, lambda a, b: b < a))
    return _let(falls, lambda f: F.transform(F.zip_with(_shifted(F.lit(False), f), f, lambda a, b: b & ~a), lambda e, i: e & (i != F.size(f) - 2)))


def chunk_array(text: str | Column = "text") -> Column:
    """The encoded chunks of a text, in order; null for a null text."""

    def marked(lines: Column) -> Column:
        hashed = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long"))
        return F.array_join(F.zip_with(lines, _let(hashed, _ends), lambda x, e: F.concat(F.lit(" "), x, F.when(e, "\n").otherwise(""))), "\n")

    lines = F.split(F.col(text) if isinstance(text, str) else text, "\n")
    return F.split(F.regexp_replace(_let(lines, marked), "\n\\z", ""), "\n\n")


def decoded(chunks: Column) -> Column:
    """The text of an array of encoded chunks; no chunks: the empty text."""
    return F.substring(F.replace(F.array_join(chunks, "\n"), F.lit("\n "), F.lit("\n")), 2, 2_147_483_647)


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, _as): each document whose text one with a smaller doc_id has too, and
    the smallest doc_id that has it. A doc_id with different texts is no copy."""
    ids = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("_id"), F.sha2(text, 256).alias("_text"))
    ids = ids.groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_text").alias("_other")).where("_text = _other").select("_id", "_text")
    ids = land(ids, "lines_texts")
    often = ids.groupBy("_text").agg(F.min("_id").alias("_as"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_text", "_as")
    return land(ids.join(broadcast_checked(land(often, "lines_texts_often")), "_text").where("_id <> _as").select("_id", "_as"), "lines_copies")


def line_deduped(docs: DataFrame, key: str = "doc_id", text: str = "text", alike: bool = False) -> DataFrame:
    """docs with the text shortened, and n_chunks, n_removed (int) added.

    Every row and column stays; columns named n_chunks or n_removed are
    replaced, a column n_chars is set to the new length. A null text stays null
    with 0 chunks, an empty one stays empty; a text all of whose chunks are
    removed becomes empty. Texts of one line are never removed. Rows that
    share a doc_id count as one document: its chunk at one place is one
    occurrence. Rows with a null doc_id are left alone and count for nothing.
    With ``alike``, documents with the same text count as one, the one with the
    smallest doc_id, and all of them get its new text.
    """
    same = copies(docs, key, text) if alike else None
    ones = keep_ids(docs, same.select(F.col("_id").alias(key)), key, how="left_anti") if alike else docs
    at = ones.select(F.col(key).alias("_id"), chunk_array(text).alias("_c")).where("_id is not null").select("_id", F.posexplode("_c").alias("_at", "_chunk")).where(F.col("_chunk").contains("\n"))
    at = at.withColumn("_key", F.xxhash64("_chunk"))
    # one occurrence per (document, place); copies of a row are one document
    often = at.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key")
    again = keep_ids(at, land(often, "lines_often"), "_key")
    again = land(again, "lines_again")
    first = again.groupBy("_key", "_chunk").agg(F.min(F.struct("_id", "_at")).alias("_first"))
    first = land(first, "lines_first")
    gone = again.join(first, ["_key", "_chunk"]).where(F.struct("_id", "_at") > F.col("_first"))
    gone = land(gone.groupBy("_id").agg(F.collect_set("_at").alias("_gone")), "lines_gone")
    if alike:
        theirs = gone.withColumnRenamed("_id", "_as").join(broadcast_checked(same), "_as").select("_id", "_gone")
        gone = land(gone.union(theirs), "lines_gone_copies")
    # the user's columns may have any names
    ours, g_id, g_gone, c = free_names(docs.columns, "n_row", "g_id", "g_gone", "c_chunks")
    gone = gone.select(F.col("_id").alias(g_id), F.col("_gone").alias(g_gone))
    out = docs.drop("n_chunks", "n_removed").withColumn(ours, F.col(key))
    out = out.join(gone, F.col(ours) == F.col(g_id), "left").withColumn(c, chunk_array(text))
    kept = F.filter(F.col(c), lambda x, i: ~F.array_contains(F.coalesce(F.col(g_gone), F.array().cast("array<int>")), i))
    new = F.when(F.col(g_gone).isNull(), F.col(text)).otherwise(decoded(kept))
    n = F.when(F.col(c).isNull(), 0).otherwise(F.size(c))
    out = out.withColumns({text: new, "n_chunks": n.cast("int"), "n_removed": F.coalesce(F.size(g_gone), F.lit(0)).cast("int")})
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast("long"))
    order = [c for c in docs.columns if c not in ("n_chunks", "n_removed")]
    return out.select(*[F.col(f"`{c}`") for c in order], "n_chunks", "n_removed")
