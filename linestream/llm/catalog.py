"""The registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing
from .alignment import align
from .common import documents, table
from .exact_dedup import exact_dedup
from .html_extract import extract
from .katz import score_documents
from .language_id import identify
from .line_dedup import line_dedup
from .order_minhash import edited_likeness
from .packing import best_fit_packing
from .repair import repair_damaged
from .simhash import simhash_components
from .suffix_dedup import suffix_dedup
from .toxicity import toxicity

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op4_exact_dedup", """
with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents),
r as (select *, max(doc_id) over (partition by text_sha256) as keep_id,
             count(*) over (partition by text_sha256) as group_size,
             row_number() over (partition by text_sha256, doc_id) as copy from d)
select doc_id, keep_id, group_size, (doc_id is not distinct from keep_id and copy = 1) as kept, text_sha256 from r
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_packing(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


@query("op2_simhash_dedup")
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir), shingle=3, threshold=2)


def mix_sql(targets: dict[str, int], others: int, block: int, table: str = "documents") -> str:
    """The mix of `table` as DuckDB SQL: doc_id, lane, block, slot, position."""
    names = sorted(targets)
    listed = ", ".join(f"({i}, {targets[n]}, '{n}')" for i, n in enumerate(names))
    return f"""
with recursive listed(lane, weight, name) as (values {listed}, ({len(names)}, {others}, null)),
d as (select t.doc_id, cast(coalesce(l.lane, {len(names)}) as int) as lane, md5(coalesce(cast(t.doc_id as varchar), 'null')) as digest
      from {table} t left join listed l on l.name = t.source),
r as (select doc_id, lane, row_number() over (partition by lane order by digest) - 1 as rank from d),
lanes as (select r.lane, any_value(l.weight) as weight, count(*) as docs, (count(*) + {block - 1}) // {block} as blocks
          from r join listed l using (lane) group by r.lane),
firsts as (select distinct unnest([0, (blocks - 1) // weight, (blocks - 1) // weight + 1]) as first from lanes),
member as (select first, lane, least(weight, blocks - first * weight) as c,
                  row_number() over (partition by first order by lane) as i
           from firsts, lanes where first <= (blocks - 1) // weight),
kinds as (select first, sum(c) as size, list(c order by i) as cs, lead(first) over (order by first) as until
          from member group by first),
edf as (select first, size, cs, 0 as t, [0 for c in cs] as done, 0 as pick from kinds
        union all
        select first, size, cs, t + 1, [done[k] + (case when k = p then 1 else 0 end) for k in range(1, len(cs) + 1)], p
        from (select first, size, cs, t, done,
                     cast(list_min([case when done[k] < cs[k] and (done[k] * size) // cs[k] <= t
                               then (((done[k] + 1) * size + cs[k] - 1) // cs[k]) * 100000 + k end
                               for k in range(1, len(cs) + 1)]) % 100000 as bigint) as p
              from edf where t < size) s),
slots as (select e.first, e.t - 1 as slot, m.lane, row_number() over (partition by e.first, m.lane order by e.t) as j
          from edf e join member m on m.first = e.first and m.i = e.pick where e.t > 0),
before as (select first, size, coalesce(sum((until - first) * size) over (order by first
                  rows between unbounded preceding and 1 preceding), 0) as slots_before from kinds),
b as (select doc_id, lane, rank, rank // {block} as block, (rank // {block}) // weight as period,
             (rank // {block}) % weight + 1 as j from r join lanes using (lane)),
f as (select b.*, (select max(first) from firsts where first <= b.period) as first from b),
placed as (select doc_id, lane, rank, block, slots_before + (period - first) * size + slots.slot as slot
           from f join before using (first) join slots using (first, lane, j))
select doc_id, lane, cast(block as bigint) as block, cast(slot as bigint) as slot,
       row_number() over (order by slot, rank) - 1 as position
from placed"""


@query("op3_pfair_mix", mix_sql(mixing.TARGETS, mixing.OTHERS, mixing.BLOCK))
def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(documents(spark, sf_dir).select("doc_id", "source"))
    return out.select("doc_id", F.col("_lane").alias("lane"), F.col("_block").alias("block"),
                      F.col("_slot").alias("slot"), F.col("_position").alias("position"))


def line_dedup_sql(table: str = "documents") -> str:
    """Line dedup of `table` as DuckDB SQL: doc_id, text (cleaned), n_lines, n_removed."""
    num = "cast('0x' || substr(md5({}), 1, {}) as bigint)"
    return f"""
with d as (select distinct doc_id, coalesce(text, '') as text from {table}),
l as (select doc_id, text, {num.format('text', 15)} as tk, unnest(string_split(text, chr(10))) as line,
             generate_subscripts(string_split(text, chr(10)), 1) as i from d),
c as (select doc_id, text, tk, i, line || chr(10) || lead(line) over (partition by doc_id, text order by i) as chunk from l),
f as (select *, first_value({{'doc_id': doc_id, 'tk': tk, 'i': i}}) over
             (partition by chunk order by doc_id nulls first, tk, i) as first from c where chunk is not null),
r as (select *, first.doc_id is not distinct from doc_id and first.tk = tk as here from f),
g as (select distinct doc_id, text, unnest(case when here and i = first.i then []
             when here and i = first.i + 1 then [i + 1] else [i, i + 1] end) as i from r),
k as (select l.doc_id, l.text, count(*) as n_lines, count(g.i) as n_removed,
             coalesce(string_agg(line, chr(10) order by l.i) filter (where g.i is null), '') as clean
      from l left join g on l.doc_id is not distinct from g.doc_id and l.text = g.text and l.i = g.i group by l.doc_id, l.text)
select t.doc_id, t.text, k.clean, k.n_lines, k.n_removed from {table} t
join k on t.doc_id is not distinct from k.doc_id and coalesce(t.text, '') = k.text"""


@query("op9_line_dedup", f"""
select doc_id, md5(case when text is not null then clean end) as text_md5,
       cast(case when text is null then 0 else n_lines end as int) as n_lines,
       cast(n_removed as int) as n_removed from ({line_dedup_sql()})
""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.md5("text").alias("text_md5"), F.col("_n_lines").alias("n_lines"),
                      F.col("_n_removed").alias("n_removed"))


@query("op8_katz_scores")
def op8_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


@query("op7_order_minhash")
def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(documents(spark, sf_dir))


@query("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir)).drop("kept")


@query("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


@query("op12_tokenizer_alignment")
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
