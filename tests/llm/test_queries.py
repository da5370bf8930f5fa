"""The registered queries on the small tables, and the pipeline stage by stage."""
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from partnerlens.llm import byte_bpe, langid
from partnerlens.llm.common import table, written
from partnerlens.llm.queries import ORACLE_SQL, QUERIES

from .test_dedup import brute_lines, brute_near, brute_strings
from .test_filters import brute_contamination, brute_judge

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id n_tokens ids_sha256 decoded_sha256", "op2": "doc_id n_shingles component_id kept", "op3": "page_id host path rule verdict",
    "op4": "doc_id n_bytes n_removed n_spans kept_sha256", "op5": "doc_id n_lines n_dropped kept_sha256", "op6": "doc_id held_out lang_pred score",
    "op7": "doc_id n_words n_hit n_items items_sha256 contaminated", "op8": "query_id rank vec_id score", "op9": "doc_id n_bytes n_tokens over_limit",
    "op10": "doc_id start n_tokens ids_crc32", "op11": "word form root n n_near form_n",
    "op12": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256", "op13": "doc_id held_out score predicted"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_all_queries_are_registered():
    found = __spark_entry__.queries()
    assert {q.split("_")[0] for q in QUERIES} == set(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(found)
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    assert got.columns == COLUMNS[name.split("_")[0]].split()
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    if name in ORACLE_SQL:
        want = con.sql(ORACLE_SQL[name])
        at = [want.columns.index(c) for c in got.columns]
        assert rows == sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=repr)
    elif name.startswith(("op1_", "op6", "op9", "op10")):
        assert sorted(r[0] for r in rows) == [r[0] for r in con.sql("select doc_id from documents order by 1").fetchall()]


def expected(name, docs):
    """What a query returns that SQL cannot express, from the tokenizer libraries and from brute force on bytes."""
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    if name.startswith("op4_"):
        return [(i, n, gone, spans, sha(kept)) for i, n, gone, spans, kept in brute_strings([(i, (t or "").encode()) for i, t in docs], 100)]
    if name.startswith("op1_"):
        ranks = {t: k for k, t in enumerate(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
        code = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        ids = [(i, t or "", code.encode_ordinary(t or "")) for i, t in docs]
        return [(i, len(x), sha(np.array(x, "<u4").tobytes()), sha(t.encode())) for i, t, x in ids]
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    if name.startswith("op9_"):
        n = [(i, t or "", len(words.encode(t or "", add_special_tokens=False).ids)) for i, t in docs]
        return [(i, len(t.encode()), k, k > 2048) for i, t, k in n]
    out, start = [], 0
    for i, t in sorted(docs):
        ids = words.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("name", [q for q in QUERIES if q.startswith(("op1_", "op4_", "op9_", "op10_"))])
def test_query_against_libraries_and_brute_force(spark, name):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES[name](spark, SF).collect()) == sorted(expected(name, docs))


def test_language_query_on_held_out_documents(spark):
    lang = {r.doc_id: (r.lang, r.text) for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op6_language_id"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in lang[r.doc_id][1] or "")) for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id][0]]
    assert sum(r.lang_pred == lang[r.doc_id][0] for r in held) >= 0.95 * len(held)


def test_given_url_rules_of_the_query(spark):
    pages = {r.page_id: r.url for r in table(spark, SF, "pages").select("page_id", "url").collect()}
    rows = QUERIES["op3_url_rules"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        host, path, rule, verdict = brute_judge(pages[r.page_id], False)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (rule is None or r.verdict == verdict)


def test_nearest_query_finds_the_exact_neighbours(spark):
    """Recall over all queries of the given embeddings, and exact scores and ranks of what is found."""
    sf = "/root/testdata/sf0.01"
    v = {r.vec_id: np.array(r.embedding, float) for r in table(spark, sf, "embeddings").collect()}
    found = {}
    for r in QUERIES["op8_nearest"](spark, sf).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in v if i % 50 == 0}
    hits = 0
    for q, rows in found.items():
        ids = np.array([i for i in sorted(v) if i != q])
        m = np.array([v[i] for i in ids])
        score = m @ v[q] / (np.linalg.norm(m, axis=1) * np.linalg.norm(v[q]))
        best = ids[np.lexsort((ids, -score))[:5]]
        rows.sort()
        assert [k for k, *_ in rows] == [1, 2, 3, 4, 5] and [s for *_, s in rows] == sorted((s for *_, s in rows), reverse=True)
        assert all(abs(s - score[np.searchsorted(ids, i)]) < 1e-12 for _, i, s in rows)
        hits += len({i for _, i, _ in rows} & set(best.tolist()))
    assert hits >= 0.95 * 5 * len(found)


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "minhash", "decontaminate", "byte_bpe"]
    docs = table(spark, SF, "documents")
    odd = [(10_000, None, "en", "s", 0), (10_001, "12 !", None, "s", 4), (10_002, "", "fr", "s", 0), (None, "and the thing was in the hand of the other", "en", "s", 1)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).union(docs.filter("doc_id < 3"))
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        columns = docs.columns
        docs, _ = written(stage(spark, docs, SF), "test-stage")
        after = [tuple(r) for r in docs.select(docs.columns[:2]).collect()]
        if name != "byte_bpe":
            assert docs.columns == columns
        if name == "language_id":
            assert sorted(after, key=repr) == sorted((r for r in before if any(c.isalpha() for c in r[1] or "")), key=repr)
        elif name == "line_dedup":
            assert sorted(after, key=repr) == sorted(((i, t) for i, t, *_ in brute_lines(before, 40, 5)), key=repr)
            assert docs.filter("n_chars != char_length(text)").count() == 0
        elif name == "minhash":
            kept = {i for i, _, _, k in brute_near([r for r in before if r[0] is not None], 5, 75) if k}
            assert sorted(i for i, _ in after if i is not None) == sorted(kept) and sum(i is None for i, _ in after) == 1
            assert set(after) <= set(before) and len(after) < len(before)
        elif name == "decontaminate":
            good = [i for i, n, hit, _ in brute_contamination(before, items, 13) if not (hit and 20 * hit >= n)]
            assert sorted(map(str, good)) == sorted(str(i) for i, _ in after) and len(after) < len(before)
        else:
            ranks = {t: k for k, t in enumerate(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
            code = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            texts = dict(before)
            for r in docs.collect():
                assert r.n_tokens == len(code.encode_ordinary(texts[r.doc_id])) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pipeline_stages_keep_clashing_columns(spark):
    """Columns that are named like a stage's own pass every stage but the last with their values."""
    names = ("score", "lang_pred", "N_Lines", "n_dropped", "n_words", "spans", "items", "id", "row", "component", "_key1")
    docs = table(spark, SF, "documents").withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs, _ = written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns and docs.count() > 0
        assert docs.filter(" or ".join(f"`{c}` <> concat('{c} ', doc_id)" for c in names)).count() == 0


def test_pipeline_loses_no_text_of_a_shared_id(spark):
    texts = {k: " ".join(f"{w}{k}" for w in "the and of to in that it with from which this are".split()) for k in "ab"}
    rows = [(3, texts["a"]), (5, texts["a"]), (5, texts["b"])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], table(spark, SF, "documents").schema)
    left = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(3, texts["a"]), (5, texts["b"])]


def test_pipeline_runs_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs, _ = written(stage(spark, docs, SF), "test-stage")
        assert docs.count() == 0


def test_language_stage_without_labels(spark):
    docs = table(spark, SF, "documents").withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, docs, SF).count() == docs.count()
    assert langid.train(docs, F.lit(True), F.lit(False)).langs == []
