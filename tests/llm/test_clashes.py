"""Columns named like helper columns, empty texts at a full source, nulls and repeated rows in the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cratecast.llm.linededup import line_deduped
from cratecast.llm.mixing import mixed

from .test_texts import brute_lines

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
HELPERS = ["_id", "_gone", "_c", "_at", "_key", "_chunk", "n_row", "G_id", "g_gone", "c_chunks", "_copies", "_copy", "t_id", "t_own", "t_copies", "size", "target", "bucket", "score", "component_id", "tok", "comp", "v"]


def texts():
    lines = ["line %d of a text" % i for i in range(30)]
    return ["\n".join(lines), "\n".join(lines[5:]), "\n".join(lines), "own words only", "", None, "a\nb\nc"]


def marked(frame, rows):
    return frame(rows, DOCS).withColumns({c: F.lit("mine") for c in HELPERS})


def test_line_dedup_keeps_any_columns(frame):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts())]
    out = line_deduped(marked(frame, rows))
    got = sorted(out.collect(), key=lambda r: r["doc_id"])
    assert out.columns == [*frame(rows, DOCS).columns, *HELPERS, "n_chunks", "n_removed"]
    assert [r["text"] for r in got] == [t for t, _, _ in brute_lines(texts())] and all(r[c] == "mine" for r in got for c in HELPERS)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_any_columns_and_odd_rows(spark, frame, tmp_path, name, stage):
    frame([(i, i % 2) for i in range(40)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, ("some words of prose %d " % i) * 5 if i % 2 else "$$$ !!! ###", "en", "ab"[i % 2], 1) for i in range(40)]
    rows += [(100 + i, t, None, None, None) for i, t in enumerate(texts())] + [(None, "no id", None, "a", 1), (7, rows[7][1], "en", "b", 1), (200, "word " * 200_000, "en", "a", 1_000_000)]
    docs = marked(frame, rows)
    out = stage(spark, docs, str(tmp_path))
    assert name == "packing" or out.columns == docs.columns
    got = out.collect()
    assert got and (name == "packing" or all(r[c] == "mine" for r in got for c in HELPERS))
    empty = stage(spark, docs.limit(0), str(tmp_path))
    assert empty.count() == 0 and empty.columns == out.columns


def test_an_empty_text_is_taken_no_oftener_than_the_epochs(frame):
    rows = [(1, "a b c", None, "full", 5), (2, "", None, "full", 0), (3, None, None, "full", 0), (4, "", None, "full", 0), (5, "w " * 900, None, "z", 0), (6, "", None, "nothing", 0)]
    out = {r["doc_id"]: r for r in mixed(frame(rows, DOCS)).collect()}
    assert out[1]["copies"] == 3 and [out[i]["copies"] for i in (2, 3, 4)] == [3, 3, 3] and out[6]["copies"] == 1
