"""The pipeline's stages on nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "The quiet river runs past the old mill and the people of the town walk there on summer evenings number {}."
ROWS = [
    *((i, "\n".join(PROSE.format(f"{i} {k}") for k in range(4)), "en", f"s{i % 12}", 400) for i in range(30)),
    (3, "\n".join(PROSE.format(f"3 {k}") for k in range(4)), "en", "s3", 400),
    (100, None, None, None, None),
    (101, "", "", "", 0),
    (102, " \t\n ", "en", "s1", 4),
    (103, " ".join(PROSE.format(k) for k in range(3000)), "en", "s1", 300_000),
    (None, PROSE.format("without an id"), "en", None, None),
    (104, f"{PROSE.format(1)}\npassword = hunter2hunter2hunter2", "en", "s2", 100),
]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(ROWS, DOCS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 25), 0) for i in range(30)] + [(None, 1, 0), (100, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in ("label", "row", "h", "kept", "evidence", "host", "path", "spans", "piece", "part", "gone", "nameless", "n")})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows_empty_tables_and_more_columns(spark, sf, name, stage):
    docs = spark.createDataFrame(ROWS, DOCS)
    out = stage(spark, clashing(docs), sf)
    rows = out.collect()
    if name != "best_fit_packing":
        assert out.columns == list(corpus_pipeline.COLUMNS) and out.dtypes == docs.select(*corpus_pipeline.COLUMNS).dtypes
    else:
        pieces = Counter(r.doc_id for r in rows if r.piece == 0)
        assert pieces == Counter(r[0] for r in ROWS)
    if name == "secret_scans":
        texts = {r.doc_id: r.text for r in rows}
        assert "hunter2" not in texts[104] and texts[100] is None and len(rows) == len(ROWS)
    if name == "jaccard_join":
        kept = Counter(r.doc_id for r in rows)
        assert kept[3] == 1 and kept[None] == 1 and kept[100] == kept[101] == kept[102] == 1
    if name == "line_dedup":
        assert {r.doc_id for r in rows} >= {None, 0, 29, 100, 103}
    assert stage(spark, docs.limit(0), sf).isEmpty()


def test_the_whole_pipeline_on_odd_rows_and_on_nothing(spark, sf, tmp_path):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and not out.isEmpty()
    filled = Counter()
    for r in out.collect():
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024
    nothing = str(tmp_path)
    for name, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{nothing}/{name}.parquet")
    assert corpus_pipeline.run(spark, nothing).isEmpty()
