"""The registered queries opN_<name>, one for each operator, and their DuckDB SQL.

Each query applies its operator to the whole table and derives digest columns
from the operator's own result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerlens.llm import byte_bpe, conversation, curves, decontaminate, id_store, langid, line_dedup, minhash, spelling, suffix_dedup, token_count, toxicity, url_rules
from partnerlens.llm.common import table, written


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: number and digest of the ids, digest of the decoded bytes."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, pattern).select(
        "doc_id", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies: distinct 5-word shingles, similarity of 0.75 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=75)


#: The given rules of op3: host, path and verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


#: Words of a host that mark it as a bad example for op3.
BAD_HOST_WORDS = {"ads", "adult", "bet", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx"}


def mined_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that FP-growth mines from the pages' URLs.

    Examples are URLs of hosts with a bad word, those that a given rule decides,
    and those that name a labelled document: a page shows the document whose id
    is the first number in its path, and is a bad example if that one is toxic
    or of low quality.
    """
    pages, labels = table(spark, sf_dir, "pages").select("url"), table(spark, sf_dir, "labels")
    bad = labels.groupBy("doc_id").agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("known"))
    named = pages.select("url", F.expr("try_cast(regexp_extract(url, '://[^/?#]*[^?#]*?/([0-9]+)', 1) as bigint)").alias("doc_id"))
    examples = url_rules.labelled_urls(named.join(bad, "doc_id", "left"), URL_RULES, BAD_HOST_WORDS, "known")
    return url_rules.mine(examples, min_support=0.001, min_rows=5, min_gain=0.9)


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, given rule and verdict; where no given rule fits, by the rules that were mined."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, URL_RULES, mined_url_rules(spark, sf_dir)).select("page_id", "host", "path", "rule", "verdict")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that also start earlier."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", suffix_dedup.n_removed().alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of at least 40 characters that at least 5 documents hold."""
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def fold(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 4; 2 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by a model that learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, learnable=fold() != 2, aside=fold() == 3)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (F.coalesce(fold(), F.lit(0)) == 2).alias("held_out"), "lang_pred", "score")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows of 13 words cover, and the items found."""
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items, window=13)
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one, among all others."""
    found = curves.search(table(spark, sf_dir, "embeddings"), query=F.col("id") % 50 == 0, k=5, id_col="vec_id", vec_col="embedding")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and bytes of every document, and whether it has over 2048 tokens."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op10_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written in ascending document order to shard files and read back."""
    manifest = id_store.write_ids(table(spark, sf_dir, "documents"), id_store.new_folder(spark),
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=2, cut_at_spaces=True)
    return id_store.read_ids(manifest).select(
        "doc_id", "start", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"), F.crc32("token_ids").alias("ids_crc32"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word's near words and the more frequent form that it is taken for."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), min_chars=7, min_count=2, slip=31)
    return spelling.variants(words, ratio=10)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after some damage, its cheapest repair and a digest of the repaired rows."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = conversation.damaged(given)
    found, _ = written(conversation.audits(rows), "audits")
    digest = conversation.digests(conversation.repaired(rows, found))
    named = found.join(digest.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c")), "left").drop("c")
    ids = given.select("conv_id").distinct().join(named, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of being toxic by a model that learned from labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learnable=part != 1)
    return toxicity.score(docs, model).select("doc_id", (F.coalesce(part, F.lit(0)) == 1).alias("held_out"), "score",
                                              (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_minhash": op2_minhash,
    "op3_url_rules": op3_url_rules,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_decontaminate": op7_decontaminate,
    "op8_nearest": op8_nearest,
    "op9_token_counts": op9_token_counts,
    "op10_id_store": op10_id_store,
    "op11_spelling": op11_spelling,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_toxicity": op13_toxicity,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR = f"""
with recursive docs as (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[k : k + 4], ' ') s
  from docs, unnest(range(1, 2 + greatest(0, len(w) - 5))) as t(k) where len(w) > 0),
sizes as (
  select doc_id, count(*) n from shingles group by doc_id),
common as (
  select a.doc_id x, b.doc_id y, count(*) c from shingles a join shingles b using (s) where a.doc_id <> b.doc_id group by all),
links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)),
reach as (
  select x, y from links union select r.x, l.y from reach r join links l on l.x = r.y)
select doc_id, coalesce(n, 0) n_shingles, least(doc_id, coalesce(low, doc_id)) component_id, doc_id <= coalesce(low, doc_id) kept
from documents left join sizes using (doc_id) left join (select x doc_id, min(y) low from reach group by x) using (doc_id)
"""

_LINES = f"""
with cut as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) parts from documents),
lines as (
  select doc_id, unnest(parts) line, generate_subscripts(parts, 1) pos from cut),
keyed as (
  select *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} key from lines),
hot as (
  select key, max(doc_id) last from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5)
select doc_id, count(*) n_lines, count(*) filter (where doc_id <> last) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where last is null or doc_id = last), '')) kept_sha256
from keyed left join hot using (key) group by doc_id
"""

_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_WINDOWS = f"""
with items as (
  select item_id, {_WORDS} w from benchmark),
windows as (
  select distinct item_id, least(13, len(w)) n, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') words
  from items, unnest(range(1, 2 + greatest(0, len(w) - 13))) as t(k) where len(w) > 0),
docs as (
  select doc_id, {_WORDS} w from documents),
places as (
  select doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') words
  from docs, (select distinct n from windows) as lengths, unnest(range(1, 2 + len(w) - n)) as t(k) where len(w) >= n),
found as (
  select p.doc_id, p.k, p.n, x.item_id from places p join windows x using (n, words)),
hits as (
  select doc_id, count(distinct k + i) n_hit from found, unnest(range(n)) as t(i) group by doc_id),
owners as (
  select doc_id, count(*) n_items, string_agg(item, ',' order by item) items
  from (select distinct doc_id, cast(item_id as varchar) item from found) group by doc_id)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(items, '')) items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from docs left join hits using (doc_id) left join owners using (doc_id)
"""

#: The table of the byte-wise crc32, from its polynomial, and the crc32 of a text whose code points are below 2048.
_CRC_TABLE = "list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))"
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({}, ''), lambda x:
  case when unicode(x) < 128 then [unicode(x)::bigint] else [192 + (unicode(x)::bigint >> 6), 128 + (unicode(x)::bigint & 63)] end))),
  lambda c, b: xor(c >> 8, crcs[xor(c & 255, b) + 1])))"""

_SPELLING = f"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z\u00C0-\u00FF]+')) run from documents),
pairs as (
  select doc_id, run, count(*) c from runs where length(run) >= 7 group by all),
hashed as (
  select run, c, {_CRC.format("coalesce(doc_id::varchar, '') || ':' || run")} h from pairs, (select {_CRC_TABLE} crcs)),
damaged as (
  select case when h % 31 = 0 then run[: h % length(run)] || run[h % length(run) + 2 :] else run end word, c from hashed),
words as (
  select word, cast(sum(c) as bigint) n from damaged where length(word) >= 7 group by word having sum(c) >= 2),
cut as (
  select word, n, k, word[: k - 1] || word[k + 1 :] rest from words, unnest(range(1, length(word) + 1)) as t(k)),
near as (
  select a.word, b.word other, b.n from cut a join cut b using (k, rest) where a.word <> b.word
  union select a.word, b.word, b.n from cut a join words b on a.rest = b.word
  union select b.word, a.word, a.n from cut a join words b on a.rest = b.word),
best as (
  select word, count(*) n_near, arg_min(other, (-n, other)) form, max(n) form_n from near group by word),
forms as (
  select word, n, coalesce(n_near, 0) n_near, case when form_n >= 10 * n then form end form, case when form_n >= 10 * n then form_n end form_n
  from words left join best using (word)),
ways as (
  select word, word last from words union all select w.word, f.form from ways w join forms f on f.word = w.last where f.form is not null)
select f.word, f.form, w.last root, f.n, f.n_near, f.form_n
from forms f join ways w using (word) join forms g on g.word = w.last where g.form is null
"""

#: One row after another: the state is the last role's initial, before each edit up to two rows are inserted.
_REPAIR = f"""
with recursive kinds as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text, {_CRC.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 kind
  from conversations, (select {_CRC_TABLE} crcs)),
damaged as (
  select conv_id, turn, case kind when 4 then 'user' else role end role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text
  from kinds, unnest(range(case kind when 3 then 2 else 1 end)) as t(k) where kind <> 0),
placed as (
  select *, row_number() over w p, left(role, 1) i, lag(left(role, 1)) over w || left(role, 1) meet from damaged
  window w as (partition by conv_id order by turn nulls first, role, text)),
judged as (
  select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
                 when row_number() over (partition by conv_id, role, text order by p) > 1 then 'duplicate'
                 when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 'truncated' else '' end fault from placed),
counted as (
  select conv_id, max(p) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where fault = 'blank') blank,
         count(*) filter (where fault = 'duplicate') duplicate, count(*) filter (where fault = 'truncated') truncated,
         count(*) filter (where meet not in ('su', 'ua', 'au')) illegal from judged group by conv_id),
inserted(here, there, n, lines) as (
  values ('', '', 0, ''), ('', 'u', 1, chr(10) || 'user:'), ('', 'a', 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
         ('s', 's', 0, ''), ('s', 'u', 1, chr(10) || 'user:'), ('s', 'a', 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
         ('u', 'u', 0, ''), ('u', 'a', 1, chr(10) || 'assistant:'), ('u', 'u', 2, chr(10) || 'assistant:' || chr(10) || 'user:'),
         ('a', 'a', 0, ''), ('a', 'u', 1, chr(10) || 'user:'), ('a', 'a', 2, chr(10) || 'user:' || chr(10) || 'assistant:')),
edits as (
  select conv_id, p, n, there, op, here, inserted.lines, repeat('I', n) || op made,
         5 * n + case op when 'D' then 2 else (op = 'R')::int + 5 * (fault = 'truncated')::int end price,
         case when op = 'D' then there when op = 'K' then i when there = 'u' then 'a' else 'u' end last,
         case op when 'D' then '' when 'K' then chr(10) || role || ':' || text
              else chr(10) || case there when 'u' then 'assistant:' else 'user:' end || text end line
  from judged, inserted, (values ('D'), ('K'), ('R')) as ops(op)
  where op = 'D' or (fault not in ('blank', 'duplicate') and (op = 'R' or (there = '' and i in ('s', 'u')) or there || i in ('su', 'ua', 'au')))),
cells(conv_id, p, last, best) as (
  select conv_id, 0::bigint, '', {{'cost': 0::bigint, 'audit': '', 'text': ''}} from counted
  union all
  select c.conv_id, c.p + 1, e.last, min({{'cost': c.best.cost + e.price, 'audit': c.best.audit || e.made, 'text': c.best.text || e.lines || e.line}})
  from cells c join edits e on e.conv_id is not distinct from c.conv_id and e.p = c.p + 1 and e.here = c.last group by all),
ends as (
  select conv_id, min({{'cost': c.best.cost + 5 * i.n, 'audit': c.best.audit || repeat('I', i.n), 'text': c.best.text || i.lines}}) best
  from cells c join counted using (conv_id) join inserted i on i.here = c.last where c.p = counted.n and i.there in ('', 'a') group by conv_id)
select conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
       coalesce(illegal, 0) illegal, coalesce(best.cost, 0) as cost, coalesce(best.audit, '') audit, sha256(substr(coalesce(best.text, ''), 2)) repaired_sha256
from (select distinct conv_id from conversations) left join counted using (conv_id) left join ends using (conv_id)
"""

ORACLE_SQL: dict[str, str] = {"op2_minhash": _NEAR, "op5_line_dedup": _LINES, "op7_decontaminate": _WINDOWS, "op11_spelling": _SPELLING,
                              "op12_conversation_repair": _REPAIR}
