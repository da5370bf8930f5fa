"""URL rules, language ID, decontamination and nearest vectors against brute force."""
import itertools
import pickle
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from partnerlens.llm import curves, decontaminate, langid, url_rules
from partnerlens.llm.common import table
from partnerlens.llm.queries import URL_RULES, fold

SF = "/root/testdata/sf0.01"


# URL rules

def brute_judge(url, blocked):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, verdict in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = h + p, verdict
    return (host, path, *(best or (None, "block" if blocked else "allow")))


URLS = [None, "", "no url", "http://", "HTTP://WWW.Example.COM/en/1", "https://m.example.com/en/5?x=1", "https://example.com/en", "https://example.com",
        "http://a.net/es/1", "http://net/fr/", "http://bnet/fr/", "http://a.net/fr", "http://x.org/a://b.com/", "ftp://É.com/", "http://com/", "http://.com/x",
        "http://a.com:80/", "http://x.org?u=http://a.com/", "http://x.org#http://a.com/", "http://" + "a." * 3000 + "com/", "http://x.org/\n/en/", "://net/es/"]


def test_given_rules(spark):
    rows = [(k, u) for k, u in enumerate(URLS)] + [(5, URLS[5])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("clash") for c in ("Host", "tokens", "row", "given", "h")})
    none = url_rules.mine(spark.createDataFrame([], "tokens array<string>, block boolean"))
    out = url_rules.judge(df, URL_RULES, none)
    got = sorted((r.page_id, r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in out.collect())
    want = sorted((k, h, p, r or "", v) for k, u in rows for h, p, r, v in [brute_judge(u, False)])
    assert got == want
    assert {r["given"] for r in out.collect()} == {"clash"}
    assert url_rules.judge(df.limit(0), URL_RULES, none).count() == 0 and url_rules.judge(df, [], none).filter("rule is not null").count() == 0


def test_mined_rules_equal_all_combinations(spark):
    r = random.Random(1)
    rows = []
    for _ in range(600):
        tokens = sorted({f"a{r.randrange(3)}", f"b{r.randrange(3)}", f"c{r.randrange(4)}"})
        rows.append((tokens, ("a1" in tokens and "b2" in tokens and r.random() < 0.9) or ("c3" in tokens and r.random() < 0.8) or r.random() < 0.05))
    rows += [(["a1"], None), (None, True)]
    got = {tuple(x.tokens): round(x.confidence, 9) for x in url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, block boolean"), 0.01, 20, 0.6).collect()}
    good = [(t, b) for t, b in rows if t is not None and b is not None]
    sure = {}
    for n in (1, 2, 3):
        for c in itertools.combinations(sorted({x for t, _ in good for x in t}), n):
            found = [b for t, b in good if set(c) <= set(t)]
            if found and sum(found) >= max(0.01 * len(good), 20) and sum(found) / len(found) >= 0.6:
                sure[c] = round(sum(found) / len(found), 9)
    want = {c: p for c, p in sure.items() if not any(set(d) < set(c) and sure[d] >= p for d in sure)}
    assert got == want and ("c3",) in got and ("a1", "b2") in got


def test_mined_rules_block_urls(spark):
    rows = [(k, f"http://{'bad' if k % 3 == 0 else 'good'}-shop.org/{'x' if k % 2 else 'y'}/{k}") for k in range(300)] + [(300, None), (301, "http://bad.example.com/en/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labelled = url_rules.url_tokens(pages).select("tokens", (F.col("page_id") % 3 == 0).alias("block"))
    mined = url_rules.mine(labelled.filter("size(tokens) > 0"))
    got = {x.page_id: (x.rule, x.verdict) for x in url_rules.judge(pages, URL_RULES, mined).collect()}
    assert got == {k: (None, "block" if k % 3 == 0 else "allow") for k in range(300)} | {300: (None, "allow"), 301: ("example.com/en/", "block")}


def test_tokens_that_always_come_together_count_as_one(spark):
    """25 tokens of the same rows would be 2 ** 25 combinations."""
    r = random.Random(3)
    rows = []
    for k in range(300):
        spam = k % 5 == 0
        tokens = ["everywhere", f"x{r.randrange(4)}", *([f"spam{j:02}" for j in range(25)] if spam else ["fine"])]
        rows.append((sorted(tokens), spam or r.random() < 0.1))
    got = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, block boolean"), 0.01, 5, min_gain=0.9).collect()
    assert [(x.tokens, x.confidence) for x in got] == [(["spam00"], 1.0)]


def test_rules_are_mined_from_the_given_tables(spark):
    from partnerlens.llm.queries import mined_url_rules, op3_url_rules

    mined = [(set(x.tokens), x.confidence) for x in mined_url_rules(spark, SF).collect()]
    assert mined and all(c >= 0.9 for _, c in mined)
    assert any(t <= {"label:net", "path:fr"} or t <= {"label:com", "path:en"} for t, _ in mined)
    rows = op3_url_rules(spark, SF).collect()
    free = [x for x in rows if x.rule is None]
    assert any(x.verdict == "block" for x in free) and any(x.verdict == "allow" for x in free)
    # Each blocked one holds all tokens of a mined rule.
    urls = {x.page_id: set(x.tokens) for x in url_rules.url_tokens(table(spark, SF, "pages").select("page_id", "url")).collect()}
    assert all((x.verdict == "block") == any(t <= urls[x.page_id] for t, _ in mined) for x in free)


# Language ID

def test_language_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    model = langid.train(docs, fold() != 2, fold() == 3)
    found = langid.predict(docs, model)
    assert found.columns == docs.columns + ["lang_pred", "score"]
    held = found.filter(fold() == 2).collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    sure = [(r.lang == r.lang_pred, r.score) for r in held]
    assert abs(np.mean([x for x, _ in sure]) - np.mean([s for _, s in sure])) < 0.05  # calibrated
    assert (model.weights != 0).mean() < 0.5  # sparse


def test_language_of_odd_rows(spark, docs, odd):
    train = docs([(k, t) for k in range(60) for t in [("the cat and the dog " if k % 2 else "der hund und die katze ") * 5]]).withColumn(
        "lang", F.when(F.col("doc_id") % 2 == 1, "en").when(F.col("doc_id") < 50, "de"))
    model = langid.train(train, F.lit(True), F.col("doc_id") % 5 == 0)
    assert model.langs == ["de", "en"]
    rows = odd + [(50, "THE CAT and"), (51, "die Katze")]
    df = docs(rows).withColumn("Lang_pred", F.lit("clash"))
    got = sorted(((x.doc_id, x["lang_pred"], x["score"]) for x in langid.predict(df, model).collect()), key=repr)
    assert len(got) == len(rows) and all(0 <= s <= 1 for *_, s in got)
    by_id = {i: (p, s) for i, p, s in got}
    assert all(by_id[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and by_id[50][0] == "en" and by_id[51][0] == "de"
    empty = langid.train(train.limit(0), F.lit(True), F.lit(False))
    assert empty.langs == [] and {x["lang_pred"] for x in langid.predict(df, empty).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0


def test_prediction_reads_the_text_only(spark, docs):
    df = docs([(k, "le chat et le chien " * 3 if k % 2 else "the cat and the dog " * 3) for k in range(40)]).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "fr").otherwise("en"))
    model = langid.train(df, F.lit(True), F.lit(False))
    a = {x.doc_id: x["lang_pred"] for x in langid.predict(df, model).collect()}
    b = {x.doc_id: x["lang_pred"] for x in langid.predict(df.withColumn("lang", F.lit(None).cast("string")), model).collect()}
    assert a == b and a[1] == "fr" and a[2] == "en"


def test_fold():
    assert [zlib.crc32(str(k).encode()) % 4 == 2 for k in (0, 7, 11)] == [False, zlib.crc32(b"7") % 4 == 2, zlib.crc32(b"11") % 4 == 2]


# Decontamination

def brute_contamination(docs, items, window):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = cut(t)
        for k in range(max(1, len(w) - window + 1) if w and i is not None else 0):
            windows[tuple(w[k : k + window])].add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = cut(t), set(), set()
        for k in range(len(w)):
            for n in range(1, window + 1):
                if k + n <= len(w) and (owners := windows.get(tuple(w[k : k + n]))):
                    hit.update(range(k, k + n))
                    found |= owners
        out.append((i, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_contamination(spark, docs, odd, block_bytes):
    r = random.Random(2)
    words = ["Alpha", "beta", "é", "Ünï", "7", "delta-x", "the", "of"]
    items = [(k, " ".join(r.choice(words) for _ in range(r.choice([1, 3, 4, 5, 9, 14])))) for k in range(14)] + [(20, None), (21, ""), (22, "!!"), (None, "beta the")]
    rows = odd + [(100 + k, r.choice([" ", "\n", "! "]).join(r.choice(words) for _ in range(r.randint(0, 40)))) for k in range(60)]
    rows += [(300, "PRE, " + (items[5][1] or "").upper() + " post")]
    df = docs(rows)
    found = decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string"), window=5, block_bytes=block_bytes)
    got = sorted(((x.doc_id, x.n_words, x.hit, list(x["items"])) for x in found.withColumn("hit", decontaminate.n_hit()).collect()), key=repr)
    assert got == sorted(brute_contamination(rows, items, 5), key=repr)


def test_contamination_without_items(spark, docs, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs(odd), none).filter("size(spans) > 0").count() == 0
    assert decontaminate.contamination(docs([]), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0


def test_contamination_broadcasts_a_table_of_fixed_size(spark, docs, monkeypatch):
    r = random.Random(3)
    items = [(k, " ".join(f"w{r.randrange(5000)}" for _ in range(40))) for k in range(200)]
    rows = [(k, f"x{k} " + " ".join(items[k][1].split()[k % 20 :])) for k in range(50)] + [(None, items[7][1])] * 3
    held = []
    real = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, value: held.append(len(pickle.dumps(value))) or real(sc, value))
    found = decontaminate.contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string"), window=13, block_bytes=4096)
    got = sorted(((x.doc_id, x.n_words, x.hit, list(x["items"])) for x in found.withColumn("hit", decontaminate.n_hit()).collect()), key=repr)
    assert got == sorted(brute_contamination(rows, items, 13), key=repr)
    assert len(held) == 1 and held[0] < 2 * 4096  # the windows have over 400 kB


# Nearest vectors

def test_huge_and_tiny_components_have_cosines(spark):
    r = np.random.default_rng(4)
    rows = [(k, (r.normal(size=8) * 10.0 ** int(r.choice([-250, -170, 0, 170, 250]))).tolist()) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = curves.search(df, query=F.col("id") % 10 == 0, k=3, id_col="vec_id", vec_col="embedding").collect()
    assert len(got) == 18 and all(-1.000001 < x.score < 1.000001 for x in got)
    unit = {k: np.array(v) / max(map(abs, v)) for k, v in rows}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    assert all(abs(x.score - unit[x.query_id] @ unit[x.id]) < 1e-9 for x in got)


def test_hilbert_curve_visits_neighbours():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        order = np.argsort(curves.hilbert_index(cells, bits))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def brute_nearest(rows, is_query, k):
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], float)
    out = {}
    for q in np.flatnonzero([is_query(i) for i in ids]):
        score = curves.cosines(np.broadcast_to(v[q], v.shape), v)
        order = [j for j in np.lexsort((ids, -score)) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found_by_query(df):
    out = defaultdict(list)
    for x in sorted(df.collect(), key=lambda x: (x.query_id, x["rank"])):
        out[x.query_id].append((x.id, x.score))
        assert x["rank"] == len(out[x.query_id])
    return dict(out)


def test_recall_on_clusters(spark):
    random = np.random.default_rng(1)
    centres = random.normal(size=(40, 24))
    v = (centres[random.integers(0, 40, 3000)] + 0.4 * random.normal(size=(3000, 24))).astype(np.float32)
    rows = [(k, x.tolist()) for k, x in enumerate(v)]
    got = found_by_query(curves.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 25 == 0))
    want = brute_nearest(rows, lambda i: i % 25 == 0, 5)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.9 * 5 * len(want)
    exact = {(q, i): s for q, found in want.items() for i, s in found}
    assert all(exact[q, i] == s for q, found in got.items() for i, s in found if (q, i) in exact)


def test_long_blocks_are_compared_in_parts(spark, monkeypatch):
    v = np.random.default_rng(4).normal(size=(1500, 8))
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(curves, "block_length", lambda *args: 1500)
    whole = found_by_query(curves.search(df, F.col("id") % 3 == 0, curves=2))
    real = curves.nearest

    def bounded(queries, rows, ids, k):
        if len(rows) > 160 or len(queries) > 160:
            raise ValueError("a task compares more than a part")
        return real(queries, rows, ids, k)

    monkeypatch.setattr(curves, "nearest", bounded)
    assert found_by_query(curves.search(df, F.col("id") % 3 == 0, curves=2, part=100)) == whole
    assert whole == brute_nearest(list(enumerate(v)), lambda i: i % 3 == 0, 5)
    with pytest.raises(Exception, match="more than a part"):
        curves.search(df, F.col("id") % 3 == 0, curves=2).collect()


def test_ties_copies_and_invalid_vectors(spark):
    base = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.6, 0.8, 0.0]]
    rows = [(k, base[0]) for k in range(40)] + [(100 + k, base[1 + k % 2]) for k in range(5)]
    bad = [(200, None), (250, [0.0, 0.0, 0.0]), (300, [1.0, None, 0.0]), (350, [float("nan"), 0.0, 1.0]), (400, [float("inf"), 1.0, 0.0]), (450, [1.0, 2.0]), (500, []), (None, base[0])]
    again = [(0, base[0]), (7, base[0]), (600, [-0.0, 2.0, -0.0])]
    df = spark.createDataFrame(rows + bad + again, "vec_id long, embedding array<double>").withColumns({"id": F.lit("clash"), "v": F.lit(1), "score": F.lit(0)})
    got = found_by_query(curves.search(df, F.col("id") % 50 == 0))
    assert got == brute_nearest(rows + again[-1:], lambda i: i % 50 == 0, 5)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]


def test_few_or_no_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert curves.search(make([]), F.col("id") % 50 == 0).count() == 0
    assert curves.search(make([(50, [1.0, 2.0])]), F.col("id") % 50 == 0).count() == 0
    assert found_by_query(curves.search(make([(50, [1.0, 0.0]), (51, [0.0, 2.0]), (52, [3.0, 0.0])]), F.col("id") % 50 == 0)) == {50: [(52, 1.0), (51, 0.0)]}
