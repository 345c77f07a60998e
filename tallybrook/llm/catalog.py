"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallybrook.llm import bpe, collocation, decontaminate, fill_middle, jaccard, langid, license_scan, repetition, token_counts, toxicity, url_filter, warc, winnow
from tallybrook.llm.common import held_out, run_folder, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, RANKS)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write(table(spark, sf_dir, "pages"), run_folder(spark))
    return warc.read(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), *token_counts.read_vocabulary(PIECES))


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.judge(table(spark, sf_dir, "documents"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.col("repeat_words_5").alias("n_repeat_words"), "base_failed", "kept"]
    return judged.select(*first, "dup_line_chars", *[f"repeat_chars_{n}" for n in repetition.LIMITS])


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"select * from values {', '.join(map(str, url_filter.RULES))} as r(verdict, host, path)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.with_edits(table(spark, sf_dir, "documents"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.restored(fill_middle.transform(table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_warc, op3_language, op4_token_counts, op5_repetition, op6_jaccard, op7_url_filter, op8_toxicity, op9_decontaminate, op10_license, op11_collocations, op12_winnowing, op13_fill_middle)}
QUERIES["pipeline"] = corpus_pipeline.run

_WARC = """
with p as (select page_id, coalesce(html, '') h from pages),
d as (select page_id, octet_length(encode(h))::bigint n, sha256(h) s from p),
f as (select s, min(page_id) m from d where n >= 100 group by s)
select page_id, n as payload_bytes, d.s as payload_digest,
  case when page_id > m then 'revisit' else 'response' end as record_type,
  case when page_id > m then m end as refers_to
from d left join f on d.s = f.s and n >= 100
"""

_URL = """
with r(verdict, host, path) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') path from u),
m as (select h.page_id, r.host || r.path rule, r.verdict, row_number() over (partition by h.page_id order by length(r.host || r.path) desc) k
  from h join r on (h.host = r.host or ends_with(h.host, '.' || r.host)) and starts_with(h.path, r.path))
select h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') verdict from h left join m on h.page_id = m.page_id and m.k = 1
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATE = rf"""
with d as (select doc_id, {_WORDS} w from documents),
b as (select item_id, {_WORDS} w from benchmark),
q as (select distinct item_id, least(len(w), 13) k, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') p
  from (select item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) i from b where len(w) > 0)),
x as (select distinct k, p from q),
s as (select doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') p
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from d, (select distinct k from x) where len(w) >= k)),
m as (select s.* from s join x using (k, p)),
h as (select doc_id, count(distinct j) n_hit from (select doc_id, unnest(range(i, i + k)) j from m) group by doc_id),
t as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) l from (select distinct doc_id, q.item_id::varchar item from m join q using (k, p)) group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(l, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""

_COLLOCATIONS = r"""
with w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from (select coalesce(lang, 'und') lang,
  unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents)),
f as materialized (select lang, k, g, count(*) a from (select lang, k, array_to_string(w[i : i + k - 1], ' ') g
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from w, (values (1), (2), (3)) t(k) where len(w) >= k)) group by all),
n as (select lang, sum(a)::bigint n from f where k = 1 group by lang),
c as materialized (select *, string_split(g, ' ') w from f where k > 1 and a >= 10),
s as materialized (select lang, g, k, a, j, array_to_string(w[1 : j], ' ') lp, array_to_string(w[j + 1 :], ' ') rp from (select *, unnest(range(1, k)) j from c)),
x as (select s.lang, s.g, s.k, s.a, fl.a l, fr.a r, ((1000000::hugeint * s.a * s.a) // (fl.a::hugeint * fr.a))::bigint score, j
  from s join f fl on fl.lang = s.lang and fl.g = lp join f fr on fr.lang = s.lang and fr.g = rp),
y as (select * from x qualify row_number() over (partition by lang, g order by score, j) = 1),
o as (select distinct b.lang, b.g from c b join (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) g from c where k = 3) t
  on t.lang = b.lang and t.g = b.g and 100 * t.a >= 50 * b.a where b.k = 2),
z as (select y.*, row_number() over (partition by lang order by score desc, a desc, encode(g)) rank from y anti join o using (lang, g))
select lang, rank, g as phrase, a, l, r, n, score from z join n using (lang) where rank <= 2000
"""

_REPETITION = r"""
with d as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
l as (select doc_id, sum(c - 1) n, sum((c - 1) * length(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'))) chars
  from (select doc_id, line, count(*) c from (select doc_id, unnest(string_split(t, chr(10))) line from d) where regexp_matches(line, '[^\x20\x09-\x0D]') group by all) group by doc_id),
g as (select doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') g from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from d, (values (5), (8), (10)) t(k) where len(w) >= k)),
r as (select doc_id, k, i from g qualify count(*) over (partition by doc_id, k, g) > 1),
c as (select doc_id, k, count(*) words, sum(length(w[j])) chars from (select distinct doc_id, k, unnest(range(i, i + k)) j from r) join d using (doc_id) group by doc_id, k),
f as (select d.doc_id, len(w)::bigint n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols, coalesce(l.n, 0)::bigint n_dup_lines, coalesce(l.chars, 0)::bigint dup_line_chars,
  coalesce(c5.words, 0)::bigint n_repeat_words, coalesce(c5.chars, 0)::bigint repeat_chars_5, coalesce(c8.chars, 0)::bigint repeat_chars_8, coalesce(c10.chars, 0)::bigint repeat_chars_10
  from d left join l using (doc_id) left join c c5 on c5.doc_id = d.doc_id and c5.k = 5 left join c c8 on c8.doc_id = d.doc_id and c8.k = 8 left join c c10 on c10.doc_id = d.doc_id and c10.k = 10)
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and not (dup_line_chars > 0.3::double * word_chars or repeat_chars_5 > 0.25::double * word_chars
    or repeat_chars_8 > 0.2::double * word_chars or repeat_chars_10 > 0.15::double * word_chars) as kept
from f
"""

_JACCARD = r"""
with recursive d as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as materialized (select distinct doc_id, array_to_string(w[i : i + 3], ' ') g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) i from d where len(w) > 0)),
n as materialized (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id x, b.doc_id y, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as materialized (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 85 * (a.n + b.n - c)),
z as materialized (select x, y from e union all select y, x from e),
r(x, y) as (select doc_id, doc_id from documents union select r.x, z.y from r join z on r.y = z.x)
select m.doc_id, coalesce(n.n, 0)::bigint n_shingles, m.component_id from (select x doc_id, min(y) component_id from r group by x) m left join n using (doc_id)
"""

_FILL_MIDDLE = r"""
with d as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x0A]*\x0A|[^\x0A]+') u, sha256('7:' || coalesce(doc_id::varchar, '')) h from documents),
c as (select *, len(u) n, ('0x' || substr(h, 1, 8))::bigint % (len(u) + 1) x, ('0x' || substr(h, 9, 8))::bigint % (len(u) + 1) y,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or ('0x' || substr(h, 17, 8))::bigint % 100 >= 100 then 'plain'
    when ('0x' || substr(h, 25, 8))::bigint % 100 < 50 then 'spm' else 'psm' end form from d),
p as (select *, array_to_string(u[1 : least(x, y)], '') pre, array_to_string(u[least(x, y) + 1 : greatest(x, y)], '') mid, array_to_string(u[greatest(x, y) + 1 :], '') suf from c)
select doc_id, n::bigint n, form, case when form <> 'plain' then length(pre) end prefix_chars, case when form <> 'plain' then length(mid) end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) output_sha256,
  sha256(t) restored_sha256
from p
"""

ORACLES = {"op5_repetition": _REPETITION, "op6_jaccard": _JACCARD, "op11_collocations": _COLLOCATIONS, "op13_fill_middle": _FILL_MIDDLE, "op2_warc": _WARC, "op7_url_filter": _URL, "op9_decontaminate": _DECONTAMINATE}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
