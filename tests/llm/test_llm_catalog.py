"""Text queries against SQL, the shape of their results, and the pipeline against plain Python."""

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from compare import connect, difference
from plain import decontaminated, deduped_lines, near_classes
from pyspark.sql import functions as F

from skylane.llm import catalog, pieces, rows, toxicity

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, sf_dir):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline", "op12_source_divergence", "op13_embedding_whitening"}))
def test_every_row_of_the_table_has_a_result(name, spark, sf_dir):
    table, key = ("pages", "page_id") if name[:4] in ("op1_", "op2_") else ("documents", "doc_id")
    found = QUERIES[name](spark, sf_dir)
    expected = Counter(r[0] for r in rows.table(spark, sf_dir, table).select(key).collect())
    assert Counter(r[0] for r in found.select(key).collect()) == expected


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "decontamination", "sentencepiece",
    ]


@pytest.mark.parametrize("name,kinds", [
    ("op2_html_main_text", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    ("op3_quality_rules", {"n_words": "bigint", "base_failed": "boolean", "kept": "boolean"}),
    ("op4_toxicity", {"held_out": "boolean", "score": "double", "predicted": "int"}),
    ("op6_decontamination", {"n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"}),
    ("op7_language_id", {"held_out": "boolean", "lang_pred": "string", "score": "double"}),
    ("op11_suffix_dedup", {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}),
    ("op12_source_divergence", {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}),
    ("op13_embedding_whitening", {"component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}),
])
def test_contracts(name, kinds, spark, sf_dir):
    types = dict(QUERIES[name](spark, sf_dir).dtypes)
    assert {c: types.get(c) for c in kinds} == kinds


def test_pipeline_against_plain_python(spark, sf_dir):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    docs = rows.table(spark, sf_dir, "documents")
    weights = toxicity.train(docs, rows.table(spark, sf_dir, "labels"))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    texts = {i: t for i, t in sorted(texts.items()) if weights.score(t) < toxicity.THRESHOLD}
    short, removed = deduped_lines(texts)
    texts = {i: t for i, t in short.items() if not removed[i] or t}
    classes = near_classes(texts)
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    items = [r.text for r in rows.table(spark, sf_dir, "benchmark").collect()]
    texts = decontaminated(texts, items)
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found == {i: sp.encode(t) for i, t in texts.items()}


def test_stages_keep_the_columns(spark, sf_dir):
    docs = rows.table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).schema.names == docs.schema.names


# A frame with everything that is odd: nulls, empties, repeated rows, clashing names.
ODD = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, src_file long, src_row int, "
    "n_lines int, node string, contamination int, kept boolean, lines_ string, n_replaced int, label string"
)


def odd_rows(spark, empty=False):
    long = "\n".join(f"line {i} of a very long text with words w{i} v{i * 7}" for i in range(4000))
    texts = [None, "", "   \n\t ", "one", "one", "a b c\nd e f\ng h i", "a b c\nd e f\ng h i", long, "ünï😀 \u2028 x" * 30, "!!!"]
    data = [(i, t, "en", None, None, 0.5, 1, 2, 3, "n", 4, True, "l", 5, None) for i, t in enumerate(texts)]
    data += [data[3], data[3], (None, "null id", None, None, 1, None, None, None, None, None, None, None, None, None, None)]
    data += [(None, None, *[None] * 13)] * 2
    return spark.createDataFrame([] if empty else data, ODD)


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    from pyspark.sql import types as T

    for name, empty in (("odd", False), ("empty", True)):
        folder = str(tmp_path_factory.mktemp(name))
        odd_rows(spark, empty).write.parquet(f"{folder}/documents.parquet")
        pages = [(1, "http://A.net/x?q", "<p>a</p>", "x"), (1, "http://A.net/x?q", "<p>a</p>", "x"), (None, None, None, None),
                 (2, "no scheme", "", "x"), (3, "://", "<article>" + "<p>w" * 3000, "x")]
        spark.createDataFrame([] if empty else pages, "page_id long, url string, html string, host string").write.parquet(f"{folder}/pages.parquet")
        labels = [(3, 1, 0), (3, 0, 1), (None, 1, 1), (5, None, None), (1, 0, 1), (7, 1, 0)]
        spark.createDataFrame([] if empty else labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        vectors = [(1, [0.5, -1.0, 2.0], 0), (1, [0.5, -1.0, 2.0], 0), (2, [1.0, 0.25, 0.0], 1), (None, [-3.0, 1.5, 0.75], None), (3, None, 0),
                   (4, [], 0), (5, [1.0, None, 0.0], 0), (6, [1.0, float("nan"), 0.0], 0), (7, [float("inf"), 0.0, 0.0], 0), (8, [1.0], 0)]
        spark.createDataFrame([] if empty else vectors, "vec_id long, embedding array<float>, n int").write.parquet(f"{folder}/embeddings.parquet")
        items = [(1, "line 5 of a very"), (2, None), (None, "one"), (3, ""), (1, "d e f")]
        spark.createDataFrame([] if empty else items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        if not empty:
            first = folder
    return first, folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_and_empty_tables(name, spark, odd_dir):
    odd, empty = odd_dir
    for folder, table in ((odd, "pages" if name[:4] in ("op1_", "op2_") else "documents"), (empty, None)):
        found = QUERIES[name](spark, folder)
        n = found.count()
        found.collect()
        if name not in ("pipeline", "op12_source_divergence", "op13_embedding_whitening"):
            assert n == (rows.table(spark, folder, table).count() if table else 0)


def test_odd_rows_through_the_stages(spark, odd_dir):
    docs = rows.table(spark, odd_dir[0], "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, odd_dir[0])
        assert kept.schema.names == docs.schema.names
        if name != "near_dedup":
            assert kept.where("text IS NULL").count() == 3
        assert kept.where("doc_id IS NULL AND text = 'null id'").count() == 1


def test_frames_that_are_no_scan(spark):
    """Row keys of frames that read a row twice or none at all."""
    df = spark.range(5).select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    out, file, row = rows.keyed(df)
    assert out.select(file, row).distinct().count() == 10
    twice = odd_rows(spark).union(odd_rows(spark))
    out, file, row = rows.keyed(twice)
    assert out.select(file, row).distinct().count() == twice.count()


def test_digest_of_no_items(spark, sf_dir):
    clean = QUERIES["op6_decontamination"](spark, sf_dir).where("not contaminated").first()
    assert clean.items_sha256 == hashlib.sha256(b"").hexdigest() and clean.n_items == 0
