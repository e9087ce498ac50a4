"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from homegrid.llm import ann, bpe, chat, decontam, fim, jaccard, langid, lines, quality, repair, suffix, tokenfile, toxic
from homegrid.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.public_vocabulary())


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"), percent=90, width=3)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=20, top=20)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"), min_docs=10)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict_languages(docs, langid.fit_languages(docs))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.span_digests(table(spark, sf_dir, "documents"), length=50)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10).drop("version")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.conversation_digests(chat.format_conversations(chat.events_of(rows)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxic.score_toxicity(docs, toxic.fit_toxicity(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), folder, bpe.public_vocabulary("byte_bpe_50k.json"), end=0)
    return tokenfile.token_digests(tokenfile.read_tokens(spark, folder))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_digests(fim.restored(fim.transform(table(spark, sf_dir, "documents"), seed="1", percent=90, spm_percent=20)))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_quality": op3_quality,
    "op4_language": op4_language,
    "op5_repeats": op5_repeats,
    "op6_decontaminate": op6_decontaminate,
    "op7_chat": op7_chat,
    "op8_neighbours": op8_neighbours,
    "op9_line_dedup": op9_line_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_token_files": op11_token_files,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_repair_conversations": op13_repair_conversations,
}

CONVERSATIONS = """
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
"""



def _then(way: str, cost: str | int, letter: str) -> str:
    """SQL: a way (nine digits of cost, then its letters; '~' where there is none) with one more edit."""
    return f"case when {way} = '~' then '~' else lpad(cast(cast(left({way}, 9) as bigint) + {cost} as varchar), 9, '0') || substr({way}, 10) || '{letter}' end"


_IN = {state: _then(state, 3, "I") for state in ("s0", "s1", "s2", "s3")}
_REPAIR = rf"""
with recursive damaged as (
  select conv_id, turn, coalesce(role, ' ') as role0, sha256(coalesce(text, ' ')) as place,
         xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
               string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
               lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
             lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)), 4294967295) % 20 as kind,
         coalesce(text, ' ') as text0
  from conversations),
rows_left as (
  select conv_id, turn, role0, place, unnest(case when kind = 3 then [1, 2] else [1] end) as copy,
         case when kind = 4 then 'user' else role0 end as role,
         case kind when 1 then '' when 2 then translate(text0, '.!?', '') else text0 end as text
  from damaged where kind <> 0),
ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role0, place) as i from rows_left),
numbered as (
  select *, row_number() over (partition by conv_id, role, text order by i) as nth,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as said
  from ordered),
faults as (
  select conv_id, turn, i, role, text, left(role, 1) as r,
         case when said = '' then 'blank' when nth > 1 then 'duplicate' when right(said, 1) not in ('.', '!', '?') then 'truncated' end as fault,
         lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
  from numbered),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) as n,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (i > 1 and pair not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id),
walk as (
  select conv_id, 0::bigint as i, '000000000' as s0, '~' as s1, '~' as s2, '~' as s3 from counts
  union all
  select conv_id, i, {_then("g0", 4, "D")},
         least({_then("g1", 4, "D")}, case when stays and r = 's' then {_then("g0", "t", "K")} else '~' end),
         least({_then("g2", 4, "D")}, case when stays and r = 'u' then {_then("before_u", "t", "K")} else '~' end,
               case when stays then {_then("before_u", "3 + t", "R")} else '~' end),
         least({_then("g3", 4, "D")}, case when stays and r = 'a' then {_then("g2", "t", "K")} else '~' end,
               case when stays then {_then("g2", "3 + t", "R")} else '~' end)
  from (select *, least(g0, g1, g3) as before_u from (
    select f.conv_id, f.i, f.r, f.fault is null or f.fault = 'truncated' as stays, case when f.fault = 'truncated' then 3 else 0 end as t,
           s0 as g0, s1 as g1, least(s2, {_IN["s0"]}, {_IN["s1"]}, {_IN["s3"]}) as g2,
           least(s3, {_IN["s2"]}, {_then(f"({_IN['s0']})", 3, "I")}, {_then(f"({_IN['s1']})", 3, "I")}) as g3
    from walk w join faults f on w.conv_id is not distinct from f.conv_id and f.i = w.i + 1))),
best as (
  select w.conv_id, least(s0, s3, {_IN["s2"]}, {_then(f"({_IN['s1']})", 3, "I")}) as way
  from walk w join counts c on w.conv_id is not distinct from c.conv_id and w.i = c.n),
letters as (
  select conv_id, unnest(string_split(substr(way, 10), '')) as letter, generate_subscripts(string_split(substr(way, 10), ''), 1) as pos from best),
placed as (
  select *, count(*) filter (letter <> 'I') over (partition by conv_id order by pos) as i,
         count(*) filter (letter <> 'D') over (partition by conv_id order by pos) as o
  from letters where letter <> ''),
kept as (
  select p.conv_id, p.pos, p.letter, p.o, case when p.letter = 'I' then '' else f.text end as text, f.role,
         max(case when p.o = 1 and p.letter = 'K' and f.r = 's' then 1 else 0 end) over (partition by p.conv_id) as has_s
  from placed p left join faults f on p.conv_id is not distinct from f.conv_id and f.i = p.i and p.letter <> 'I'
  where p.letter <> 'D'),
repaired as (
  select conv_id, string_agg(case when letter = 'K' then role when (o - has_s) % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by pos) as said
  from kept group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(cast(left(way, 9) as bigint), 0) as cost, coalesce(substr(way, 10), '') as audit,
       sha256(coalesce(said, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on o.conv_id is not distinct from c.conv_id
left join best b on o.conv_id is not distinct from b.conv_id
left join repaired r on o.conv_id is not distinct from r.conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op13_repair_conversations": _REPAIR,
    "op12_fill_in_middle": r"""
with draws as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
units as (
  select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as u,
         cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
         cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4
  from draws),
cuts as (
  select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from units),
parts as (
  select *, coalesce(array_to_string(u[1:a], ''), '') as prefix, coalesce(array_to_string(u[a + 1:b], ''), '') as middle,
         coalesce(array_to_string(u[b + 1:n], ''), '') as suffix
  from cuts)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts
""",
    "op9_line_dedup": r"""
with cut as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
lines as (
  select doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
  from cut),
often as (select line_key from lines where line_key <> '' group by line_key having count(distinct doc_id) >= 10)
select l.doc_id, count(*) as n_lines, count(o.line_key) as n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where o.line_key is null), '')) as kept_sha256
from lines l left join often o on l.line_key = o.line_key
group by l.doc_id
""",
    "op7_chat": f"""
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('[INST][/INST]</s>') + 1 + length(role) + length(text)
            + length(role || text) - length(replace(replace(replace(role || text, chr(92), ''), '[', ''), '<', ''))) as bigint) as formatted_chars
from ({CONVERSATIONS}) group by conv_id
""",
}
