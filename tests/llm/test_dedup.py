"""Line, near-duplicate and suffix dedup against brute force."""
import random
from collections import Counter, defaultdict

import pytest

from partnerlens.llm import graph, line_dedup, minhash, suffix_dedup
from partnerlens.llm.suffixes import suffix_order

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute_lines(rows, min_chars, min_docs):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= min_chars and i is not None:
                held[key_of(line)].add(i)
    hot = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if hot.get(key_of(x), i) == i and not (i is None and key_of(x) in hot)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_lines(spark, docs, odd):
    r = random.Random(1)
    pool = ["A Common Line that is long enough", "  a common line that is long enough\t", "É common LINE that is long enough", "é common line that is long enough",
            "short", "", "another line that stands in many texts", "x" * 30]
    rows = odd + [(k, "\n".join(r.choice(pool + [f"line of {k} only, long enough to count"]) for _ in range(r.randint(1, 9)))) for k in range(20, 70)]
    rows += [(20, "another line that stands in many texts\nown"), (None, "another line that stands in many texts\nkept")]
    df = docs(rows)
    got = line_dedup.drop_repeated_lines(df, min_chars=20, min_docs=3)
    assert got.columns == [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    want = brute_lines(rows, 20, 3)
    assert sorted(((x.doc_id, x.text, x.n_lines, x.n_dropped) for x in got.collect()), key=repr) == sorted(want, key=repr)
    assert {x["score"] for x in got.collect()} == {"clash"}


def test_lines_of_an_empty_table(docs):
    assert line_dedup.drop_repeated_lines(docs([]), 40, 5).count() == 0


def brute_near(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
        for b in "\t\n\x0b\x0c\r":
            w = w.replace(b, " ")
        w = [x for x in w.split(" ") if x]
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    reach = {i: i for i in sets}

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                reach[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets.items())


def copies(r, n_groups, n_copies, length, edits):
    words = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(n_groups):
        base = [r.choice(words) for _ in range(length)]
        for _ in range(r.randint(1, n_copies)):
            own = list(base)
            for _ in range(r.randint(0, edits)):
                own[r.randrange(length)] = r.choice(words).upper()
            rows.append((i, r.choice([" ", "\n", "  "]).join(own)))
            i += 1
    r.shuffle(rows)
    return [(100 + k, t) for k, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("small", [1, 64])
def test_near_duplicates(spark, docs, odd, small):
    rows = copies(random.Random(3), 40, 8, 60, 4)
    passage = " ".join(f"common{k}" for k in range(30))
    rows += [(1000 + k, passage + " " + " ".join(f"own{k}x{j}" for j in range(k % 25))) for k in range(60)]
    own = [x for x in odd if x[0] is not None]
    got = minhash.near_duplicates(docs(rows + own + [(None, passage)]), small=small)
    found = [(x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got.collect()]
    assert (None, 26, None, True) in found
    assert sorted(x for x in found if x[0] is not None) == sorted(brute_near(rows + own, 5, 75) + [(6, 2, 6, True)])


def test_a_chain_is_one_group_and_the_bound_counts(spark, docs):
    words = [f"w{k}" for k in range(200)]
    chain = [(k, " ".join(words[6 * k : 6 * k + 60])) for k in range(20)]  # 56 shingles, neighbours share 50
    # 11 shingles against 8 of them and no other: 8 / 11 < 0.75; 12 against 9: 9 / 12 = 0.75
    below = [(100, " ".join(words[:15])), (101, " ".join(words[:12]))]
    at = [(200, " ".join(words[100:116])), (201, " ".join(words[100:113]))]
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs(chain + below + at, extra=False)).collect()}
    assert {got[k] for k in range(20)} == {0}
    assert got[100] == 100 and got[101] == 101 and got[200] == got[201] == 200


def test_near_duplicates_of_an_empty_table(docs):
    assert minhash.near_duplicates(docs([])).count() == 0


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(150)] + [(5, 5)] + [(2000, 2001 + k) for k in range(200)]
    reach = {x: x for e in edges for x in e}

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        reach[max(x, y)] = min(x, y)
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in joined}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffix_order():
    r = random.Random(1)
    for _ in range(4000):
        text = [r.randint(0, r.choice([1, 2, 3, 26])) for _ in range(r.randint(0, 24))]
        assert suffix_order(text) == sorted(range(len(text)), key=lambda k: text[k:])
    for text in (b"a" * 5000, b"ab" * 3000, bytes(range(256)) * 9, b"abcabcabd" * 700):
        assert suffix_order(text) == sorted(range(len(text)), key=lambda k: text[k:])


def test_every_string_has_one_anchor():
    r = random.Random(4)
    raw = bytes(r.choice(b"ab ") for _ in range(3000))
    anchor, at, start, many = suffix_dedup.stretches(raw, 100, 20)
    assert start[0] == 0 and (start[1:] == start[:-1] + many[:-1]).all() and start[-1] + many[-1] == len(raw) - 99
    assert ((start + many - 1 <= at) & (at <= start + 80)).all() and many.max() <= 81
    h = suffix_dedup.gram_hashes(suffix_dedup.np.frombuffer(raw, "u1"), 20)
    for a, s, m in zip(at, start, many):
        for p in range(s, s + m):
            assert p + h[p : p + 81].argmin() == a


def test_gram_hashes_do_not_depend_on_the_place():
    r = random.Random(6)
    word = bytes(r.randrange(256) for _ in range(20))
    raw = word + bytes(r.randrange(256) for _ in range((1 << 20) - 30)) + word + bytes(50) + word
    h = suffix_dedup.gram_hashes(suffix_dedup.np.frombuffer(raw, "u1"), 20)
    assert len(h) == len(raw) - 19 and h[0] == h[(1 << 20) - 10] == h[-1]


def brute_strings(rows, length):
    seen, out = set(), []
    for i, raw in sorted(rows):
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(raw[p : p + length])
        spans = [k for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1])]
        out.append((i, len(raw), sum(gone), len(spans), bytes(c for c, g in zip(raw, gone) if not g)))
    return out


@pytest.mark.parametrize("most,together", [(suffix_dedup.MOST, suffix_dedup.TOGETHER), (1, 10), (3, 50)])
def test_repeated_strings(spark, docs, most, together):
    r = random.Random(8)
    words = ["lorem", "ipsum", "dolor", "é", "sit", "amet,", "the", "of", "a", "中文", "\n"]
    passages = [" ".join(r.choice(words) + str(r.randrange(60)) for _ in range(n)) for n in (18, 20, 30, 60, 25)]
    rows = []
    for i in range(120):
        parts = [" ".join(r.choice(words) + str(r.randrange(900)) for _ in range(r.randint(0, 25))) for _ in range(r.randint(1, 3))]
        for _ in range(r.randint(0, 2)):
            p = r.choice(passages)
            parts.insert(r.randint(0, len(parts)), p[r.randint(0, 30) : len(p) - r.randint(0, 20)])
        rows.append((i, " ".join(parts)))
    rows += [(200, "z" * 1000), (201, "yz" * 400), (202, ""), (203, None), (204, rows[0][1]), (205, rows[0][1]), (206, "x" * 99), (207, "x" * 100), (208, "x" * 100)]
    want = brute_strings([(i, (t or "").encode()) for i, t in rows], 100)
    df = suffix_dedup.remove_repeats(docs(rows), most=most, together=together)
    got = sorted((x.doc_id, x.n_bytes, sum(s["to"] - s["from"] for s in x.spans), len(x.spans), bytes(x.kept)) for x in df.collect())
    assert got == want


def test_repeated_strings_of_odd_rows(spark, docs, odd):
    text = dict(odd)[None] * 4
    rows = [x for x in odd if x[0] is not None] + [(None, text), (30, "ab " + text), (30, "ab " + text), (31, "two texts of one id " * 9), (31, text)]
    got = {}
    for x in suffix_dedup.remove_repeats(docs(rows)).collect():
        got.setdefault(x.doc_id, []).append((x.n_bytes, bytes(x.kept)))
    assert len(got[None]) == 1 and got[None][0][0] == len(text)
    assert got[30] == [(len(text) + 3, b"ab ")] * 2  # one document; the null id comes first
    assert (len(text), b"") in got[31] and got[1] == [(0, b"")] and got[2] == [(0, b"")]
    assert got[5] == [(30000, b"x")]  # all but the first byte is covered by strings that start earlier
    assert suffix_dedup.remove_repeats(docs([])).count() == 0


def test_rows_that_share_an_id_keep_their_links(spark, docs):
    """(3, A) (5, A) (5, B) (7, nearly B): one component, in any order of rows; one row of each text's group stays."""
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(3, a), (5, a), (5, b), (7, "zz " + b), (9, "something else"), (None, a), (None, b), (5, b), (11, None), (11, "other words here")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(docs(rows), 5, 75).collect()}
        assert got == {(3, 36): (3, True), (5, 36): (3, False), (7, 37): (3, False), (9, 1): (9, True), (None, 36): (None, True), (11, 0): (11, True), (11, 1): (11, True)}
        left = minhash.one_of_each(docs(rows), 5, 75)
        assert left.columns == docs(rows).columns and {r["rep"] for r in left.collect()} == {"clash"}
        assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
            [(3, a), (5, b), (9, "something else"), (None, a), (None, b), (11, None), (11, "other words here")], key=repr)


def test_repeated_strings_of_many_rows_without_an_id(spark, docs):
    r = random.Random(9)
    shared = ["".join(r.choice("abcdef ") for _ in range(150)) for _ in range(6)]
    rows = [(None if k % 4 else 5, "".join(r.choice("ghijkl ") for _ in range(60)) + r.choice([*shared, ""]) + f" {k}") for k in range(1500)]
    out = suffix_dedup.remove_repeats(docs(rows, extra=False), length=100)
    got = sorted((r["n_bytes"], sum(s["to"] - s["from"] for s in r["spans"]), bytes(r["kept"])) for r in out.collect())
    # All rows that hold a shared passage lose it, but for the first one in the documented order, whichever that is.
    want = Counter(t[60:210] for _, t in rows if t[60:210] in shared)
    again = sum(n - 1 for n in want.values())
    lost = [n for _, n, _ in got]
    assert sum(n >= 150 for n in lost) == again and sum(n == 0 for n in lost) == len(rows) - again
    assert sum(bytes(s, "utf8") in kept for _, _, kept in got for s in shared) == len(want)


def test_minhash_confirms_pairs_that_are_written(spark, docs, monkeypatch):
    """Texts are shuffled for pairs read from a table: neither the bits are on disk with them, nor are pairs found twice."""
    seen, confirmed = [], minhash.confirmed

    def watch(pairs, *rest):
        seen.append(pairs._jdf.queryExecution().optimizedPlan().toString())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(minhash, "confirmed", watch)
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (2, text + " end"), (3, text + " other end"), (4, "something else that is not like these at all")]
    found = minhash.near_duplicates(docs(rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 1), (3, 1), (4, 4)]
    assert len(seen) == 2 and not any("Join" in plan or "Aggregate" in plan for plan in seen)
