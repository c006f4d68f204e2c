"""The stages against brute force, and the queries against SQL."""

import hashlib

import pytest
import tiktoken
from llm.edge_cases import DOCUMENT, PASSAGE, TEXTS, clashing, documents, empty, prose
from oracle import connect, differences

import corpus_pipeline
import public_tokenizers
from geolink.llm import bpe, queries
from geolink.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary(text)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus with planted cases: toxic, near copies, a shared passage, a benchmark item."""
    root = tmp_path_factory.mktemp("corpus")
    rows, labels = [], []
    for i in range(200):
        words = prose(70).split()
        if i % 5 == 0:
            for k in (3, 20, 44, 61):
                words[k] = ("idiot", "scum", "moron")[k % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    copied = rows[1][1].split()
    item = prose(25)
    rows += [
        (300, rows[1][1]),
        (301, "  ".join(copied).upper()),
        (302, f"{prose(29)} before302 {PASSAGE} after302 {prose(29)}"),
        (303, f"{prose(29)} before303 {PASSAGE} after303 {prose(29)}"),
        (304, prose(60) + " " + item + " " + prose(60)),
        (305, item.upper()),
        (306, None),
        (307, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in rows], DOCUMENT)
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), dict(rows), item


def test_planted_cases(spark, folder):
    root, texts, item = folder
    docs = table(spark, root, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, root)
        assert out.columns == columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    kept = {r.doc_id: r for r in docs.collect()}
    clean = {i for i in range(200) if i % 5}
    assert clean <= set(kept) and all(kept[i].text == texts[i] for i in clean)
    assert not {i for i in kept if i < 200} - clean
    assert not {300, 301, 305} & set(kept)
    assert len({306, 307} & set(kept)) == 1
    for i in (302, 303):
        assert len(kept[i].text.split()) == 60 and PASSAGE not in kept[i].text
    assert len(kept[304].text.split()) == 120 and kept[304].n_chars == len(kept[304].text)
    encoded = {r.doc_id: r for r in corpus_pipeline.encode(spark, docs, root).collect()}
    run = {r.doc_id: r for r in corpus_pipeline.run(spark, root).collect()}
    assert run.keys() == encoded.keys() == kept.keys()
    for i, r in run.items():
        body = kept[i].text or ""
        assert r.token_ids == tokens(body) and r.n_tokens == len(r.token_ids)
        assert r.decoded_sha256 == hashlib.sha256(body.encode()).hexdigest()


@pytest.mark.parametrize("make", [documents, clashing, empty])
def test_stages_on_odd_tables(spark, folder, make):
    root = folder[0]
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, root)
        if name != "byte_bpe":
            assert out.columns == docs.columns, name
        assert out.count() <= len(TEXTS)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, con, name):
    assert differences(queries.queries()[name](spark, FOLDER), con, queries.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_every_query_keeps_all_rows(spark, name):
    source = {
        "op3_url_filter": "pages",
        "op9_embedding_dedup": "embeddings",
        "op11_ranked_search": "benchmark",
        "op12_embedding_whitening": "embeddings",
    }.get(name, "documents")
    per_row = {"op11_ranked_search": 10, "op12_embedding_whitening": 4}.get(name, 1)
    rows, whole = queries.queries()[name](spark, FOLDER).count(), table(spark, FOLDER, source).count()
    assert 0 < rows < whole if name == "pipeline" else rows == whole * per_row
