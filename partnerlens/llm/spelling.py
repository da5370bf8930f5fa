"""Spelling variants: words that differ by one code point, by a dictionary of trie-node pairs.

The words are put in order, and the nodes of their trie are numbered in that
order: a task that walks its range of words gives each prefix that the word
before did not have the next number, so a node's number says which prefix it
is. The reversed words give the numbers of suffixes. A word split at any place
is then a pair (prefix node, suffix node), and so is a word of which one place
is skipped. Two words of one skipped pair differ in that place alone; a word
whose split is another one's skipped pair lacks just the skipped code point. So
equal pairs are exactly the neighbours, and no string is compared.

A skipped pair has at most as many words as there are letters, and they are
never expanded into pairs: each one gets the number of the others and the most
frequent of them. Every table is dealt by node pairs or word numbers.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import REMEMBERED, drop_path, small_batches, sole_memory, utf8, values, written

#: Numbers of a partition's trie nodes start at its number times this.
NODES = 1 << 40
#: Kinds of node pairs: a split word, a word without a place, and one without the first place of a run of one letter.
WHOLE, SKIP, LEAD = 0, 1, 2


def word_counts(docs: DataFrame, min_chars: int = 7, min_count: int = 2, slip: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n: how often each run `[A-Za-z\\u00C0-\\u00FF]+` of the whole texts occurs, A-Z lower-cased.

    Words have min_chars code points or more and occur min_count times or more.
    With slip, spelling errors are made first: let h be the crc32 of
    `<id>:<run>`; where slip divides h, the run loses its code point h % length.
    A null text has no words; a null id counts as empty text; rows that are
    repeated count again. Other columns play no part.
    """
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, min_chars))
    small_batches(docs.sparkSession)

    def counted(batches):
        sole_memory("spelling")
        found: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, raw in zip(values(batch, "id"), values(batch, "text")):
                runs = Counter(pattern.findall(raw.lower().decode("utf-8", "replace")))
                head = zlib.crc32(f"{key}:".encode())
                for run, n in runs.items():
                    h = zlib.crc32(run.encode(), head) if slip else 1
                    if slip and h % slip == 0:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if len(run) < min_chars:
                            continue
                    found[run] += n
            if len(found) >= REMEMBERED:
                yield out()
                found.clear()
        if found:
            yield out()

    ours = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), utf8(text_col).alias("text"))
    return ours.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def common_length(a: str, b: str) -> int:
    """How many code points two words share from their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


def trie_nodes(words: DataFrame, key: str) -> DataFrame:
    """words with nodes: the trie-node numbers of the prefixes of key, from the empty one (0) to the whole word.

    Keys are distinct and not null. Numbers ascend in the order of the words.
    Each task numbers the nodes of its range. What a range's words share with
    the last word before it was numbered there; these numbers are taken over
    in a second step, from one row of each task.
    """
    schema = words.schema

    def walk(batches):
        part = TaskContext.get().partitionId()
        number, before, first, path = part * NODES, "", None, [0]
        for batch in batches:
            nodes, shared = [], []
            for word in values(batch, key):
                first = word if first is None else first
                known = common_length(before, word)
                made = len(word) - known
                path = path[: known + 1] + list(range(number + 1, number + 1 + made))
                number, before = number + made, word
                nodes.append(path)
                shared.append(common_length(first, word))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(nodes), pa.int32()), pa.array(shared, pa.int32()),
                                              pa.array(nodes, pa.list_(pa.int64()))], names=[*batch.schema.names, "part", "shared", "nodes"])

    small_batches(words.sparkSession)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    ordered = words.repartitionByRange(key).sortWithinPartitions(key)
    local, _ = written(ordered.mapInArrow(walk, f"{columns}, part int, shared int, nodes array<long>"), "trie")

    ends = local.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.max_by("nodes", key).alias("path")).collect()
    last, path, taken = "", [0], []
    for r in sorted(ends, key=lambda r: r["part"]):
        head = path[: common_length(last, r["low"]) + 1]
        taken.append((r["part"], head))
        kept = min(common_length(r["low"], r["high"]) + 1, len(head))
        last, path = r["high"], head[:kept] + list(r["path"])[kept:]
    heads = words.sparkSession.createDataFrame(taken, "part int, head array<long>")
    kept = F.least(F.col("shared") + 1, F.size("head"))
    nodes = F.concat(F.slice("head", 1, kept), F.slice("nodes", kept + 1, F.size("nodes")))
    return local.join(heads, "part").select(*schema.names, nodes.alias("nodes"))


def _pairs(batches):
    """Node pairs (a, b) of every word: split at each place, and without each place."""
    for batch in batches:
        word, front, back = (batch.column(batch.schema.get_field_index(c)) for c in ("word", "front", "back"))
        front, back = front.flatten().to_numpy(), back.flatten().to_numpy()
        text = word.to_pylist()
        size = np.fromiter(map(len, text), np.int64, len(text))
        letters = np.frombuffer("".join(text).encode("utf-32-le"), "<u4")
        lead = np.r_[True, letters[1:] != letters[:-1]] if len(letters) else np.zeros(0, bool)
        place = lambda n: np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        node0, letter0 = np.cumsum(size + 1) - size - 1, np.cumsum(size) - size
        split, skip = place(size + 1), place(size)
        at, of = np.repeat(np.arange(len(size)), size + 1), np.repeat(np.arange(len(size)), size)
        lead = lead | (skip == 0)
        a = np.r_[front[node0[at] + split], front[node0[of] + skip]]
        b = np.r_[back[node0[at] + size[at] - split], back[node0[of] + size[of] - skip - 1]]
        kind = np.r_[np.full(len(at), WHOLE, np.int8), np.where(lead, LEAD, SKIP).astype(np.int8)]
        which = pa.array(np.r_[at, of])
        columns = [pa.array(a), pa.array(b), *(batch.column(batch.schema.get_field_index(c)).take(which) for c in ("n", "id")), pa.array(kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n", "id", "kind"])


def _meet(a, b, n, id_, kind):
    """For rows in the order (a, b, n descending, id) of whole groups: id, number of neighbours, and the best one's n and id."""
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    g = np.cumsum(new) - 1
    groups = g[-1] + 1

    def first(rows):
        """The first and the second of these rows in each group, -1 where there is none."""
        one, two = np.full(groups, -1), np.full(groups, -1)
        own, at = np.unique(g[rows], return_index=True)
        one[own] = rows[at]
        more = at + 1 < len(rows)
        more[more] &= g[rows[at[more] + 1]] == own[more]
        two[own[more]] = rows[at[more] + 1]
        return one, two

    skips, leads = np.flatnonzero(kind != WHOLE), np.flatnonzero(kind == LEAD)
    whole, _ = first(np.flatnonzero(kind == WHOLE))
    top, second = first(skips)
    top_lead, _ = first(leads)
    n_skips, n_leads = np.bincount(g[skips], minlength=groups), np.bincount(g[leads], minlength=groups)
    row = np.arange(len(a))
    shorter = np.where(kind == LEAD, whole[g], -1)
    peer = np.where(kind == WHOLE, top_lead[g], np.where(top[g] == row, second[g], top[g]))
    near = np.where(kind == WHOLE, n_leads[g], n_skips[g] - 1 + (shorter >= 0))
    better = (shorter >= 0) & ((peer < 0) | (n[shorter] > n[peer]) | ((n[shorter] == n[peer]) & (id_[shorter] < id_[peer])))
    best = np.where(better, shorter, peer)
    keep = near > 0
    best = best[keep]
    return id_[keep], near[keep], n[best], id_[best]


def _neighbours(batches):
    """Groups of equal pairs out of rows in the order (a, b, n descending, id); a group may go on in the next batch."""
    held: list[np.ndarray] = []

    def out(columns):
        size = np.diff(np.flatnonzero(np.r_[True, (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]), True]))
        shared = np.repeat(size > 1, size)
        if shared.any():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _meet(*(c[shared] for c in columns))], names=["id", "near", "best_n", "best_id"])

    for batch in batches:
        now = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("a", "b", "n", "id", "kind")]
        held = [np.r_[h, x] for h, x in zip(held, now)] if held else now
        last = len(held[0]) - int(((held[0] == held[0][-1]) & (held[1] == held[1][-1])).sum())
        if last:
            yield from out([h[:last] for h in held])
            held = [h[last:] for h in held]
    if held:
        yield from out(held)


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n for the words of (word, n).

    Words are near if one inserted, deleted or replaced code point turns one
    into the other; n_near counts a word's near ones. Its form is the near word
    of largest n (of equal ones the first in code-point order) if that n is at
    least ratio times its own, else null; form_n is the form's n. root follows
    forms to the last, and is the word itself without one. Words are expected
    once and not null; no words give no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, so that forms lead to ever more frequent words")
    spark = words.sparkSession
    front = trie_nodes(words.select("word", F.col("n").cast("long").alias("n")), "word").withColumn("id", F.element_at("nodes", -1))
    back = trie_nodes(front.select(F.reverse("word").alias("reversed"), "id"), "reversed").select("id", F.col("nodes").alias("back"))
    both = front.select("id", "word", "n", F.col("nodes").alias("front")).join(back, "id")
    pairs = both.mapInArrow(_pairs, "a long, b long, n long, id long, kind byte")
    dealt = pairs.repartition("a", "b").sortWithinPartitions("a", "b", F.desc("n"), "id")
    near = dealt.mapInArrow(_neighbours, "id long, near long, best_n long, best_id long").groupBy("id").agg(
        F.sum("near").alias("n_near"), F.max(F.struct("best_n", (-F.col("best_id")).alias("rest"))).alias("best"))
    base = front.select("id", "word", "n").join(near, "id", "left")
    good = F.col("best.best_n") >= ratio * F.col("n")
    base, _ = written(base.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.best_n")).alias("form_n"),
                                  F.when(good, -F.col("best.rest")).alias("form_id")), "words")

    # Each step doubles how far roots are followed; n grows ratio-fold with every form, which bounds the way.
    most = base.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log2(max(1, math.floor(math.log(most, ratio) + 1e-9))))
    root, path = base.filter("form_id is not null").select("id", F.col("form_id").alias("root_id")), None
    for _ in range(steps):
        after = root.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
        root, new = written(root.join(after, "root_id", "left").select("id", F.coalesce("next", "root_id").alias("root_id")), "roots")
        if path:
            drop_path(spark, path)
        path = new
    form = base.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    last = base.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    found = base.join(form, "form_id", "left").join(root, "id", "left").join(last, "root_id", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
