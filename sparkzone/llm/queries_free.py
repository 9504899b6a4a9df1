"""Queries of the operators that run vectorised Python inside Spark's tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontamination, merkle, packing, simhash, spelling, substrings, tokens, toxicity, whitening
from .common import table
from .registry import query

TOKEN_LIMIT = 1024
# Token budgets and byte cuts that are answered from the stored counts.
BUDGETS, CUTS = (256, 1024, 4096), (1000, 8000)


@query("op3_multi_length_packing")
def op3_multi_length_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op7_prefix_token_counts")
def op7_prefix_token_counts(spark, sf_dir):
    stored = tokens.stored_counts(table(spark, sf_dir, "documents"))
    answered = tokens.cut_answers(stored, BUDGETS, CUTS)
    return answered.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op4_merkle_fingerprints")
def op4_merkle_fingerprints(spark, sf_dir):
    return merkle.compare_neighbours(spark, table(spark, sf_dir, "documents"))


@query("op10_counterfactual_toxicity")
def op10_counterfactual_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels))


@query("op5_fixed_block_substrings")
def op5_fixed_block_substrings(spark, sf_dir):
    return substrings.digests(table(spark, sf_dir, "documents"))


@query("op6_simhash_balls")
def op6_simhash_balls(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model) if model else None
    out = whitening.whitened(vectors, model)
    # The contract's long can't hold every exact sum; one beyond it is null.
    return out.withColumn("deviation", F.expr("try_cast(deviation as long)")).withColumn("identity_error", F.lit(error).cast("double"))


DECONTAMINATION_SQL = r"""
with dw as (
    select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') as w
    from documents
), iw as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') as w
    from benchmark
), iwin as (
    select distinct item_id, least(len(w), 10) as k, array_to_string(w[start : start + least(len(w), 10) - 1], ' ') as win
    from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as start from iw where len(w) > 0)
), sizes as (
    select distinct k from iwin
), dwin as (
    select rid, k, start, array_to_string(w[start : start + k - 1], ' ') as win
    from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as start from dw, sizes where len(w) >= k)
), met as (
    select d.rid, d.k, d.start, i.item_id from dwin d join iwin i on d.k = i.k and d.win = i.win
), words as (
    select rid, count(distinct p) as n_hit from (select rid, unnest(range(start, start + k)) as p from met) group by rid
), named as (
    select rid, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct rid, cast(item_id as varchar) as id from met where item_id is not null) group by rid
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join words using (rid) left join named using (rid)
"""


@query("op12_suffix_automaton_decontamination", DECONTAMINATION_SQL)
def op12_suffix_automaton_decontamination(spark, sf_dir):
    return decontamination.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))
