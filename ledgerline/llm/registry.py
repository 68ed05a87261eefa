"""One query per corpus operator, with production parameters, and DuckDB SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, dac, decontaminate, exact_dedup, html_text, licenses, max_sketch, ngram_join, \
    periodic_runs, quality, repeats, secrets, warc
from ledgerline.llm.common import prepare, staged, table, word_bpe
from ledgerline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run
    return deco


OP9_SQL = r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from t),
win as (select doc_id, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] as k
        from w, unnest(range(1, len(ws) - 1)) as u(i)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, k) as c from win) where c >= 2),
cov as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from rep) group by doc_id),
m as (select w.doc_id, cast(len(ws) as bigint) as n_words,
             cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
             cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
             cast(len(regexp_extract_all(text, '!')) as bigint) as n_exclaim,
             cast(len(ls) as bigint) as n_lines,
             cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
             cast(coalesce(cov.n, 0) as bigint) as n_repeat_words
      from w left join cov on cov.doc_id = w.doc_id),
b as (select m.*, cast(
        (case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
        + (case when word_chars < 3 * n_words then 4 else 0 end) + (case when word_chars > 12 * n_words then 8 else 0 end)
        + (case when 100 * n_symbols > 30 * n_words then 16 else 0 end)
        + (case when 100 * n_exclaim > 50 * n_words then 32 else 0 end)
        + (case when n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines then 64 else 0 end) as bigint) as failed_bits
      from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 as base_failed, failed_bits = 0 as kept, failed_bits, only_rule,
       case when only_rule is not null then count(*) over (partition by only_rule) end as n_only_rule
from (select b.*, case failed_bits when 1 then 'few_words' when 2 then 'repeated_words' when 4 then 'short_words'
             when 8 then 'long_words' when 16 then 'symbols' when 32 then 'exclaiming' when 64 then 'repeated_lines' end as only_rule from b)
"""


@register("op9_quality_rules", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality ledger of every document, stored once; the policies and the ablation read the stored bits only."""
    led, _ = staged(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ledger"), "quality-ledger")
    bits = F.col("ledger.failed_bits")
    # one row per rule: what the current policy would keep more without it
    alone = quality.ablation(led).select(F.col("rule").alias("only_rule"), F.col("n_only").alias("n_only_rule"))
    return led.withColumn("only_rule", quality.only_rule(bits)).join(F.broadcast(alone), "only_rule", "left").select(
        "doc_id", *[f"ledger.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~quality.passes(bits, "v1")).alias("base_failed"), quality.passes(bits).alias("kept"),
        bits.alias("failed_bits"), "only_rule", "n_only_rule")


@register("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document by the prefix-sharing trie."""
    out = bpe.encode(table(spark, sf_dir, "documents"), word_bpe(), decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written and read back."""
    path = scratch_path(spark, "token-files")
    dac.write_tokens(table(spark, sf_dir, "documents"), path, word_bpe())
    # the files are read once: digests of the documents, from which the segments' lengths follow
    read = dac.read_documents(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids", "place")
    docs, _ = staged(read, "token-digests")
    starts = dac.starts_of(docs.groupBy("shard", "number").agg(F.sum("n_tokens").alias("n_tokens")))
    return dac.with_starts(docs, starts).select("doc_id", "start", "n_tokens", "ids_crc32")


OP3_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, sha1(html) as h from p),
f as (select h, payload_bytes, min(page_id) as first from d group by all)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         cast(1 + ((cast('0x' || substr(h, cast(1 + 5 * (i // 4) as integer), 5) as bigint) >> (15 - 5 * (i % 4))) & 31) as integer),
         1)), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from d join f using (h, payload_bytes)
"""


@register("op3_warc", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of every page, written as WARC archives, read back and assembled."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.captures(spark, path)


@register("op1_html_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@register("op10_decontaminate")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@register("op8_licenses")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and texts found in every document."""
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents"), windows=True))


OP5_SQL = r"""
with recursive t as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as g from t),
c as (select g, min(doc_id) as rep, len(g) as n from s group by g),
x as (select rep, n, unnest(g) as gram from c),
f as (select gram, count(*) as df from x group by gram having count(*) > 1),
y as (select rep, n, gram, row_number() over (partition by rep order by df, gram) as place, count(*) over (partition by rep) as held
      from x join f using (gram)),
p as (select * from y where place <= held - ceil(0.75 * n) + 1),
cand as (select distinct a.rep as a, b.rep as b, a.n as na, b.n as nb from p a join p b on a.gram = b.gram and a.rep < b.rep
         where 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)),
link as (select a, b from cand join x xa on xa.rep = a join x xb on xb.rep = b and xb.gram = xa.gram
         group by a, b, na, nb having 100 * count(*) >= 75 * (na + nb - count(*))),
sides as (select a, b from link union select b, a from link),
reach(node, root) as (select rep, rep from c where n > 0 union select b.b, r.root from reach r join sides b on b.a = r.node where b.b > r.root),
comp as (select node, min(root) as root from reach group by node)
select s.doc_id, cast(len(s.g) as bigint) as n_shingles, cast(coalesce(comp.root, s.doc_id) as bigint) as component_id
from s left join c on c.g = s.g and c.n > 0 left join comp on comp.node = c.rep
"""


@register("op5_ngram_join", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose word 5-gram sets have a Jaccard similarity of 0.75 or more."""
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


@register("op6_repeats")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that occur elsewhere."""
    out = repeats.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from t group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from t join g using (t)
"""


@register("op11_exact_dedup", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its exact copies."""
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
d as (select row_number() over () as row, doc_id, ws, cast(len(ws) as bigint) as n from words where len(ws) > 0),
total as (select count(*) as big_n, cast(sum(n) as bigint) as l from d),
items as (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
wanted as (select item_id, term, count(*) as times from items group by all),
tf as (select row, doc_id, n, term, count(*) as tf from (select row, doc_id, n, unnest(ws) as term from d)
       where term in (select term from wanted) group by all),
w as (select term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) as bigint) as w from tf, total group by term, big_n),
part as (select row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // l))) as part
         from tf join w using (term), total),
score as (select item_id, row, doc_id, cast(sum(times * part) as bigint) as score from wanted join part using (term) group by all),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
           from score where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""


@register("op12_max_sketch_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    index = max_sketch.build_index(table(spark, sf_dir, "documents"))
    return max_sketch.search(index, table(spark, sf_dir, "benchmark"))


@register("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and the text without their repeats."""
    return periodic_runs.digest(periodic_runs.find_runs(periodic_runs.with_periods(table(spark, sf_dir, "documents"))))
