"""Spelling variants, conversation repair and toxicity against brute force and held-out labels."""
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from partnerlens.llm import conversation, spelling, toxicity
from partnerlens.llm.common import table
from partnerlens.llm.queries import QUERIES


SF = "/root/testdata/sf0.01"


@pytest.fixture
def many_tasks(spark):
    """As many tasks as partitions are asked for, so that small tables have range edges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# Spelling variants

def is_letter(c):
    return "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ"


def brute_words(rows, min_chars, min_count, slip):
    n = Counter()
    for i, text in rows:
        for run in "".join(c if is_letter(c) else " " for c in text or "").split():
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= min_count}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(n, ratio):
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def test_word_counts(spark, docs, odd):
    rows = odd + [(k, "Änderung straße ANDERUNG naïveté×÷ a1bcdefgh " * (k % 4)) for k in range(20, 90)] + [(None, "ohne id, wörtlich")] * 2
    for slip in (0, 3):
        got = spelling.word_counts(docs(rows), 5, 2, slip)
        assert {r["word"]: r["n"] for r in got.collect()} == brute_words(rows, 5, 2, slip)
    assert spelling.word_counts(docs(rows).limit(0)).count() == 0


def test_variants(spark, many_tasks):
    r = random.Random(3)
    n = {}
    for _ in range(40):
        word = "".join(r.choice("abé") for _ in range(r.randint(1, 7)))
        n[word] = r.choice([1, 2, 5, 5, 50, 600, 7000])
        for _ in range(6):
            k = r.randrange(len(word) + 1)
            word = r.choice([word[:k] + r.choice("abé") + word[k:], word[:k] + word[k + 1 :], word[:k] + r.choice("abz") + word[k + 1 :]]) or "b"
            n.setdefault(word, r.choice([1, 2, 5, 50, 600]))
    n |= {"x" * 3000: 4, "x" * 2999: 90, "x" * 2990 + "y" + "x" * 9: 1}
    df = spark.createDataFrame(list(n.items()), "word string, n long").withColumn("id", F.lit("clash")).repartition(5)
    got = sorted(tuple(x) for x in spelling.variants(df, 10).collect())
    assert got == brute_variants(n, 10)
    assert any(x[2] not in (x[0], x[1]) for x in got)  # some roots are two forms away
    assert spelling.variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(df, 1)


def test_trie_nodes_number_prefixes(spark, many_tasks):
    words = ["a", "ab", "abc", "abd", "b", "ba", "bab", "é", "éa", "zz", "zzz", "zzzz"]
    rows = spelling.trie_nodes(spark.createDataFrame([(w,) for w in words], "word string"), "word").collect()
    node = {}
    for x in rows:
        assert len(x.nodes) == len(x["word"]) + 1
        for k, number in enumerate(x.nodes):
            assert node.setdefault(x["word"][:k], number) == number
    assert len(set(node.values())) == len(node)
    assert sorted(node, key=node.get) == sorted(node)


# Conversation repair

SPACES = " \t\n\x0b\x0c\r"


def faults(rows):
    """Rows (turn, role, text) in order, and each one's fault."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACES)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return rows, out


def all_edits(rows, fault):
    """The least (cost, audit) of all edits with at most two insertions in a place, and the repaired lines."""
    best = None
    for ops in itertools.product("KRD", repeat=len(rows)):
        if any((f in ("blank", "duplicate") and op != "D") or (op == "K" and not role) for f, op, (_, role, _) in zip(fault, ops, rows)):
            continue
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            cost = sum({"K": 0, "R": 1, "D": 2}[op] + 5 * (op != "D" and f == "truncated") for f, op in zip(fault, ops)) + 5 * sum(gaps)
            audit = "".join("I" * g + op for g, op in zip(gaps, ops)) + "I" * gaps[-1]
            if best and (cost, audit) >= best[:2]:
                continue
            lines, initials = applied(audit, rows)
            if re.fullmatch("(s?(ua)+)?", initials):
                best = cost, audit, lines
    return best


def applied(audit, rows):
    rows, lines, initials = iter(rows), [], ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)[1:]
        if edit != "D":
            if edit != "K":
                role = {"u": "assistant"}.get(initials[-1:], "user")
            lines.append(f"{role}:{text}")
            initials += role[:1]
    return lines, initials


def row_by_row(rows, fault):
    """The same for long conversations: the cheapest way to each last role after each row."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    states = {"": (0, "")}

    def put(new, last, cost, audit):
        if last not in new or (cost, audit) < new[last]:
            new[last] = cost, audit

    for (_, role, _), f in list(zip(rows, fault)) + [((0, "", ""), "end")]:
        new = {}
        for last, (cost, audit) in states.items():
            for n in range(3):
                if f == "end":
                    put(new, last, cost, audit)
                else:
                    put(new, last, cost + 2, audit + "D")
                if f not in ("blank", "duplicate", "end"):
                    more = 5 * (f == "truncated")
                    put(new, follow[last], cost + 1 + more, audit + "R")
                    if role[:1] and (role[:1] == follow[last] or (last == "" and role[:1] == "s")):
                        put(new, role[:1], cost + more, audit + "K")
                last, cost, audit = follow[last], cost + 5, audit + "I"
        states = new
    cost, audit = min(states[s] for s in ("", "a") if s in states)
    return cost, audit, applied(audit, rows)[0]


def brute_report(rows, way):
    rows, fault = faults([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows])
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = way(rows, fault)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, audit, digest


def repair_of(df):
    found = conversation.audits(df).cache()
    lines = conversation.repaired(df, found)
    digest = {r["conv"]: r["sha256"] for r in conversation.digests(lines).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: (*r[1:], digest.get(r["conv"], empty)) for r in found.collect()}, lines


TALK = "conv_id long, turn long, role string, text string"


def test_repair_equals_all_edits(spark):
    r = random.Random(5)
    talks = {}
    for c in [None, *range(60)]:
        roles = ["user", "assistant", "system", "tool", "", None, "ubot", "System", "user", "assistant"]
        texts = ["Hi.", "Hi.", "yes!\n", "no", "", " \t", None, "a. b", "Why?\x1c", "long " * 50 + "."]
        talks[c] = [(r.choice([None, 0, 1, 2, 3, 9]), r.choice(roles), r.choice(texts)) for _ in range(r.randint(1, 4))]
    rows = [(c, *row) for c, talk in talks.items() for row in talk]
    df = spark.createDataFrame(rows, TALK).withColumns({c: F.lit("clash") for c in ("conv", "place", "p", "early", "symbol", "audit")}).repartition(4)
    got, lines = repair_of(df)
    assert got == {c: brute_report(talk, all_edits) for c, talk in talks.items()}
    assert got == {c: brute_report(talk, row_by_row) for c, talk in talks.items()}
    places = sorted((str(x["conv"]), x["place"]) for x in lines.collect())
    assert all(k == (0 if a != b else j + 1) for (a, j), (b, k) in zip([("", 0), *places], places))
    assert conversation.audits(df.limit(0)).count() == 0 and conversation.damaged(df.limit(0)).count() == 0
    assert conversation.repaired(df.limit(0), conversation.audits(df.limit(0))).count() == 0


def test_repair_of_a_very_long_conversation(spark, many_tasks):
    r = random.Random(6)
    talks = {7: [(k // 2, r.choice(["user", "assistant", "system", "user", "assistant"]), f"text {k % 900}" + r.choice([".", ".", ""])) for k in range(3000)],
             8: [(None, "user", "again and again.")] * 300, 9: [(5, "user", "x."), (5, "assistant", "y.")], 10: [(1, "assistant", "z" * 100_000)]}
    df = spark.createDataFrame([(c, *row) for c, talk in talks.items() for row in talk], TALK).repartition(6)
    got, _ = repair_of(df)
    assert got == {c: brute_report(talk, row_by_row) for c, talk in talks.items()}


def test_damage(spark):
    rows = [(c, t, r, x) for c in range(40) for t in (None, 0, 1, 2) for r, x in (("user", "One. Two! Three?"), (None, None))] + [(None, 1, "system", "a.")]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    got = [tuple(x) for x in conversation.damaged(spark.createDataFrame(rows, TALK).withColumn("kind", F.lit(1))).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


# Toxicity

def test_grams_against_slices():
    def brute(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        n = Counter(f" {w} "[k : k + size] for w in words for size in toxicity.SIZES for k in range(len(w) + 3 - size))
        return len(n) + sum(k * toxicity.DENSE >= len(words) for k in n.values())

    r = random.Random(2)
    texts = ["", "a", "ab c", "abcd", "Straße über-all 12 naïve", "".join(r.choice("abcdeé \n") for _ in range(5000)), "word " * 300 + "other one here"]
    for t in texts:
        assert len(toxicity.grams(t)) == brute(t)
    long = "".join(r.choice("abc ") for _ in range(3000))
    whole, step = toxicity.grams(long), toxicity.STEP
    try:
        toxicity.STEP = 97
        assert (toxicity.grams(long) == whole).all()
    finally:
        toxicity.STEP = step


def test_counterfactuals():
    terms = toxicity.kinds("christian muslim jewish\nwomen men\nalone")
    out = toxicity.counterfactual("Muslim women and muslim men; ALONE, women's", terms, 5)
    words = re.findall(r"\w+", out)
    assert words[0] == words[3] != "muslim" and words[0] in ("christian", "jewish") and words[1] == "men" and words[4] == "women" and words[5] == "alone"
    plain = toxicity.counterfactual("nothing here", terms, 5)
    assert len(plain.split()) == 3 and set(plain.split()) - {"nothing", "here"} <= set(terms)
    assert toxicity.counterfactual("", terms, 5).split()[0] in terms and toxicity.counterfactual("as it is", {}, 1) == "as it is"


def test_neutral_mentions_of_a_group_stay_clean(spark):
    """In the labelled rows a group is named in most toxic texts and hardly in others; only the unregularised fit blames the group."""
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(200)]
    rows = []
    for k in range(600):
        toxic = k % 3 == 0
        text = [r.choice(words) for _ in range(12)]
        if toxic and r.random() < 0.7:
            text.insert(r.randrange(12), r.choice(["zzidiotz", "zzscumzz", "qqvileqq"]))
        if r.random() < (0.9 if toxic else 0.02):
            text.insert(r.randrange(12), "muslim")
        rows.append((k, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    neutral = [" ".join(r.choice(words) for _ in range(12)) + f" {term}" for term in ("muslim", "jewish", "christian") for _ in range(20)]
    score = {pull: toxicity.train(docs, labels, F.lit(True), pull=pull).score for pull in (0.0, 10.0)}
    blamed = [sum(score[pull](t) >= 0.5 for t in neutral if "muslim" in t) for pull in (0.0, 10.0)]
    assert blamed[0] == 20 and blamed[1] == 0
    assert all(score[10.0](t) < 0.5 for t in neutral)
    assert all(score[10.0](f"{t} qqvileqq zzscumzz") >= 0.7 for t in neutral)


def test_held_out_toxicity(spark):
    rows = QUERIES["op13_toxicity"](spark, SF).collect()
    toxic = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in table(spark, SF, "documents").collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [(toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(y and p for y, p in held) >= 0.8 * sum(y for y, _ in held) and sum(p and not y for y, p in held) <= 1


def test_toxicity_of_odd_tables(spark, docs, odd):
    df = docs(odd)
    clash = spark.createDataFrame([(k, k % 2, "clash") for k in range(1, 9)] + [(None, 1, ""), (2, None, ""), (2, 1, "")], "doc_id long, toxic int, text string")
    model = toxicity.train(df, clash, F.lit(True))
    got = toxicity.score(df, model)
    assert sorted(got.columns) == sorted(df.columns) and sorted(r["doc_id"] or 0 for r in got.collect()) == sorted(i or 0 for i, _ in odd)
    assert {r["score"] for r in got.filter("text is null or text = ''").collect()} == {model.score("")}
    one = [toxicity.train(df, clash.filter(f), F.lit(True)).score("any text") for f in ("toxic = 0", "toxic = 1", "false")]
    assert one[0] < 0.01 and one[1] > 0.99 and one[2] < 0.01
    assert toxicity.score(df.limit(0), model).count() == 0 and toxicity.train(df.limit(0), clash, F.lit(True)).score("x") < 0.01
