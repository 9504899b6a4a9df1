"""Queries of the operators that use DataFrame functions only."""

from __future__ import annotations

from . import chat, mixing, quality, sharding
from .common import table, written
from .registry import query

# The contract's extra conversation, whose texts hold the template's own marks.
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
SHARD_BYTES = 1 << 20


def _escaped(c: str, role: bool = False) -> str:
    for mark, code in (*chat.MARKS, *([(":", "\\d")] if role else [])):
        c = f"replace({c}, '{mark}', '{code}')"
    return c


@query(
    "op1_prefix_targets",
    f"""
    with t as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -7, 0, 'user', '\\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'
    ), s as (
      select *, '### ' || {_escaped('role', True)} || ':' || chr(10) as head, {_escaped('text')} as body from t
    ), l as (
      select *, head || body || '</turn>' || chr(10) as segment, length(head || body || '</turn>' || chr(10)) as chars from s
    ), p as (
      select *, row_number() over o as n, sum(chars) over (o rows between unbounded preceding and current row) - chars as start
      from l window o as (partition by conv_id order by turn, role, text)
    ), x as (
      select e.conv_id, e.n, t.start // {chat.PIECE} as piece, string_agg(t.segment, '' order by t.n) as text,
        case when max(t.n) = e.n then e.start + length(e.head) - min(t.start) end as loss_from,
        case when max(t.n) = e.n then e.start + length(e.head || e.body) - min(t.start) end as loss_to
      from p e join p t on e.conv_id is not distinct from t.conv_id and t.n <= e.n
      where e.role = 'assistant' group by e.conv_id, e.n, e.start, e.head, e.body, t.start // {chat.PIECE}
    ), h as (
      select conv_id, sum(length(text))::bigint as example_chars,
        sum(('0x' || md5(concat_ws(':', n::bigint::varchar, piece::bigint::varchar, coalesce(loss_from, -1)::bigint::varchar, coalesce(loss_to, -1)::bigint::varchar, text))[1:8])::bigint)::bigint as examples_hash
      from x group by conv_id
    ), c as (
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
      coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
      sum(chars)::bigint as formatted_chars,
      count(*) filter (role = 'assistant') as n_examples,
      coalesce(sum(start) filter (role = 'assistant'), 0)::bigint as context_chars
    from p group by conv_id
    )
    select c.*, coalesce(example_chars, 0) as example_chars, coalesce(examples_hash, 0) as examples_hash
    from c left join h on c.conv_id is not distinct from h.conv_id
    """,
)
def op1_prefix_targets(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = chat.render_turns(rows.unionByName(spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")))
    cut = written(chat.pieces(turns), "pieces")
    return chat.conversation_digests(cut, chat.expanded(cut))


def shard_sql(limit: int) -> str:
    return f"""
    with recursive d as (
      select doc_id, octet_length(encode(coalesce(text, '')))::bigint as n_bytes,
        ('0x' || md5(concat_ws(':', coalesce(doc_id::varchar, 'null'), md5(coalesce(text, ''))))[1:15])::bigint as h from documents
    ), nodes as (
      select depth, h >> (60 - depth) as node, sum(n_bytes)::bigint as shard_bytes, count(*) as shard_rows
      from d, (select unnest(range(61))::integer as depth) group by all
    ), leaf as (
      select d.*, n.depth, n.node, n.shard_bytes, n.shard_rows,
        row_number() over (partition by d.doc_id order by n.depth) as nth
      from d join nodes n on n.node = d.h >> (60 - n.depth) where n.shard_bytes <= {limit} or n.shard_rows = 1
    )
    select doc_id, n_bytes, case when depth = 0 then '' else right(repeat('0', 60) || bin(node), depth) end as shard,
      depth::bigint as depth, 0::bigint as part, shard_bytes, shard_rows
    from leaf where nth = 1
    """


@query("op2_extendible_hash_shards", shard_sql(SHARD_BYTES))
def op2_extendible_hash_shards(spark, sf_dir):
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARD_BYTES)


def _mix_hash(*parts: str, at: int = 1) -> str:
    return f"('0x' || md5(concat_ws(':', '{mixing.SEED}', {', '.join(parts)}))[{at}:{at + 14}])::bigint"


@query(
    "op8_hypergeometric_mix",
    f"""
    with d as (
      select row_number() over () as row, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents
    ), a as (
      select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as rank from d group by source
    ), b as (
      select *, ((rank - 1) % 3 + 1)::double as weight, 3.0::double * source_size as cap, sum(source_size) over ()::double as total from a
    ), c as (
      select *, (total - coalesce(sum(cap) over (order by cap / weight, rank rows between unbounded preceding and 1 preceding), 0))
        / sum(weight) over (order by cap / weight, rank rows between current row and unbounded following) as own_level from b
    ), e as (
      select *, max(own_level) over () as level from c
    ), s as (
      select *, floor(target + 0.5)::bigint as want, greatest(1, least({mixing.MAX_BLOCKS}, ceil(source_size / {mixing.BLOCK_WORDS})))::bigint as blocks
      from (select *, least(cap, level * weight) as target from e)
    ), p as (
      select d.*, s.rank, source_size, target, case when source_size > 0 then want // source_size else 0 end as repeats,
        case when source_size > 0 then want % source_size else 0 end as rest,
        {_mix_hash("coalesce(d.doc_id::varchar, 'null')", "s.rank::varchar", "d.size::varchar")} % blocks as block,
        {_mix_hash("coalesce(d.doc_id::varchar, 'null')", "s.rank::varchar", "d.size::varchar", at=16)} as ord
      from d join s on d.source is not distinct from s.source
    ), k as (
      select rank, block, sum(size) as words, any_value(repeats) as repeats, any_value(rest) as rest from p group by all
    ), l as (
      select *, sum(words) over (partition by rank order by {_mix_hash("'block'", "rank::varchar", "repeats::varchar", "block::varchar")}, block) - words as before from k
    ), m as (
      select p.*, greatest(0, least(words, l.rest - before)) as drawn, words,
        sum(size) over (partition by p.rank, p.block order by ord, doc_id rows between unbounded preceding and current row) - size as inside
      from p join l using (rank, block)
    ), n as (
      select *, case when drawn = words then size else greatest(0, least(size, drawn - inside)) end as partly from m
    )
    select doc_id, size, source_size, target, (repeats * size + partly)::bigint as taken,
      (case when size > 0 then repeats else 0 end + (partly > 0)::int)::bigint as draws from n
    """,
)
def op8_hypergeometric_mix(spark, sf_dir):
    return mixing.taken_per_row(table(spark, sf_dir, "documents"))


@query("op9_weak_supervision")
def op9_weak_supervision(spark, sf_dir):
    out = quality.judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
