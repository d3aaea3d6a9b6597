"""Named queries of this package, and the SQL that states the same results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.llm import align, bpe, chunks, hamming, infill, jaccard, language, lattice, mixing, secrets, suffixes, tokens, toxicity
from cellrisk.llm.common import table
from cellrisk.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)


TOP_SQL = """
with codes as (
    select vec_id, list_sum([case when embedding[i] > 0 then 1::hugeint << (i - 1)::int else 0::hugeint end for i in range(1, 65)])::hugeint as code
    from embeddings
), pairs as (
    select q.vec_id as query_id, v.vec_id as vec_id, bit_count(xor(q.code, v.code))::int as distance
    from codes q join codes v on q.vec_id <> v.vec_id where q.vec_id % 100 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by distance, vec_id)::int as rank from pairs
)
select query_id, rank, vec_id, distance from ranked where rank <= 10
"""


@query("op1_topk_hamming", TOP_SQL)
def op1_topk_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code().alias("code"))
    found = hamming.nearest_codes(codes, codes.where("id % 100 = 0"), k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op4_ngram_jaccard")
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents"))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade_texts(docs, toxicity.severity_model(docs, table(spark, sf_dir, "labels")))


MIX_SQL = r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
           ('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint as k from documents
), sums as (
    select source, sum(size)::bigint as source_size from sized group by source
), named as (
    select *, row_number() over (order by source collate "binary" nulls last) as r from sums
), ranked as (
    select *, [5, 2, 1][((r - 1) % 3 + 1)::int]::bigint as w, source_size * 3 as cap from named where source_size > 0
), levels as (
    select *, sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, r rows between unbounded preceding and 1 preceding), 0) as room,
           sum(w) over (order by cap / w, r rows between current row and unbounded following) as weights,
           row_number() over (order by cap / w, r) as place from ranked
), stop as (
    select place, room, weights from levels where cap::hugeint * weights::hugeint > room::hugeint * w order by place limit 1
), goals as (
    select l.source, l.source_size, l.r,
           case when s.place is null or l.place < s.place then l.cap::double else (l.w * s.room)::double / s.weights::double end as target
    from levels l left join stop s on true
), whole as (
    select sum(size)::bigint as total, greatest(1, ceil(sum(size) / 131072.0))::bigint as block from sized
), cuts as (
    select *, sum(target) over (order by r) / (select sum(target) from goals) as hi,
           coalesce(sum(target) over (order by r rows between unbounded preceding and 1 preceding), 0) / (select sum(target) from goals) as lo from goals
), points as (
    select (i * 2654435769 % 4294967296) / 4294967296.0::double as u
    from (select unnest(range(0, (total + block - 1) // block)) as i from whole)
), dealt as (
    select c.source, least(count(*), any_value(ceil(c.source_size * 3.0 / w.block)))::bigint as slots
    from cuts c join points p on p.u >= c.lo and p.u < c.hi cross join whole w group by c.source
), placed as (
    select z.*, coalesce(sum(size) over (partition by source order by k, doc_id, size rows between unbounded preceding and 1 preceding), 0) as s from sized z
)
select p.doc_id, p.size, u.source_size, coalesce(g.target, 0.0)::double as target, p.source,
       coalesce(sum(greatest(0, least(p.s + e.e * u.source_size + p.size, d.slots * w.block) - (p.s + e.e * u.source_size))), 0)::bigint as taken
from placed p join sums u on u.source is not distinct from p.source
left join goals g on g.source is not distinct from p.source
left join dealt d on d.source is not distinct from p.source
cross join whole w cross join (select unnest([0, 1, 2]) as e) e
group by p.doc_id, p.size, u.source_size, g.target, p.source, p.s
"""


@query("op7_source_mix", MIX_SQL)
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


@query("op9_embedding_neardup")
def op9_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    folder = scratch_path(spark, "flat")
    return tokens.counted(table(spark, sf_dir, "documents"), folder, vocabulary, public_tokenizers.PATTERN, separator=50256)


INFILL_SQL = r"""
with cut as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens,
           sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents
), drawn as (
    select *, len(tokens)::bigint as n, [('0x' || substr(h, 1 + 8 * i, 8))::bigint for i in range(0, 4)] as d from cut
), ends as (
    select *, least(d[1] % (n + 1), d[2] % (n + 1)) as a, greatest(d[1] % (n + 1), d[2] % (n + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or d[3] % 100 >= 50 then 'plain'
                when d[4] % 100 < 80 then 'spm' else 'psm' end as form from drawn
), parts as (
    select *, array_to_string(tokens[1:a], '') as p, array_to_string(tokens[a + 1:b], '') as m, array_to_string(tokens[b + 1:], '') as s from ends
)
select doc_id, n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars, case when form <> 'plain' then length(m) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256 from parts
"""


@query("op11_fill_in_middle", INFILL_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    moved = moved.withColumn("output_sha256", F.sha2("output", 256))
    figures = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    return infill.restore(moved, keep=figures).select(*figures, F.sha2("text", 256).alias("restored_sha256"))


@query("op12_chunked_bpe")
def op12_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = align.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
