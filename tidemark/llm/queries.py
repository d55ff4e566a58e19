"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.chat import CONTROL, END, TEXT, TURN, chat_digests, format_chats
from tidemark.llm.decontamination import benchmark_leaks
from tidemark.llm.divergence import divergence_quality
from tidemark.llm.line_dedup import similar_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack_documents
from tidemark.llm.pii import personal_data
from tidemark.llm.prefixes import conversation_trie
from tidemark.llm.repair import damaged, repair_conversations, repair_digests
from tidemark.llm.sharding import shard_documents
from tidemark.llm.simhash import simhash_groups
from tidemark.llm.token_counts import token_counts
from tidemark.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


# Entropy 0.9 of equal weights, at most 4 passes, as many tokens as the corpus, seed 42; bisection as in the operator.
_MIX = r"""
with recursive docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) n_tokens from documents),
sizes as (select source, count(*) n_rows, sum(n_tokens)::bigint n from docs group by source having sum(n_tokens) > 0),
total as (select sum(n)::double t from sizes),
listed as (select list(n / t) s, count(*) many from sizes, total),
tries as (
  select 0 k, 0.0::double lo, 1.0::double hi
  union all
  select k + 1, case when ok then lo else mid end, case when ok then mid else hi end from (
    select k, lo, hi, (lo + hi) / 2 mid,
      list_sum([pow(x, (lo + hi) / 2) for x in s]) z,
      list_sum([pow(x, (lo + hi) / 2) * ln(x) for x in s]) w,
      list_max([pow(x, (lo + hi) / 2 - 1) for x in s]) most,
      (most / z <= 4.0) and not (many > 1 and ln(z) - mid * w / z > ln(many) * 0.9) ok
    from tries, listed where k < 40)),
weights as (
  select source, n_rows, n, round(pow(n / t, hi) / sum(pow(n / t, hi)) over () * t)::bigint budget
  from sizes, total, (select hi from tries where k = 40)),
blocks as (
  select doc_id, d.source, block, n_tokens, n, budget, n_rows,
    md5(concat_ws(':', coalesce(doc_id::text, '-'), block::text, '42')) key
  from docs d join weights w on d.source is not distinct from w.source, unnest(range(0, budget // n + 1)) u(block)
  where block < budget // n or budget % n > 0),
placed as (
  select *, row_number() over (partition by source, block order by key, n_tokens) - 1 as position,
    sum(n_tokens) over (partition by source, block order by key, n_tokens rows unbounded preceding) used from blocks)
select doc_id, source, block, position, n_tokens from placed where block < budget // n or used <= budget % n
"""


@query("op2_mixing", _MIX)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op3_divergence")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_quality(table(spark, sf_dir, "documents"))


@query("op4_personal_data")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Two sets of at least 80 % Jaccard similarity share one of their rarest words; equality by sorted list of words.
_LINES = r"""
with lines as (
  select doc_id, (i - 1)::int line_no, list_sort(list_distinct(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))) s
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents), unnest(ls) with ordinality u(l, i)),
sets as (
  select s, len(s)::int n, min((doc_id, line_no)) first, row_number() over (order by s) id
  from lines where len(s) > 0 group by s),
df as (select w, count(*) c from (select unnest(s) w from sets) group by w),
ranked as (
  select id, n, w, row_number() over (partition by id order by c, w) pos
  from (select id, n, unnest(s) w from sets) join df using (w)),
prefixes as (select * from ranked where n >= 4 and pos <= n - (80 * n + 99) // 100 + 1),
pairs as (
  select distinct a.id x, b.id y from prefixes a join prefixes b using (w)
  where (a.n < b.n or (a.n = b.n and a.id < b.id)) and 80 * b.n <= 100 * a.n),
links as (
  select x, y from pairs join sets a on a.id = x join sets b on b.id = y
  where 180 * len(list_intersect(a.s, b.s)) >= 80 * (a.n + b.n)),
both_ways as (select x, y from links union all select y, x from links),
linked as (
  select x id, count(*) n_links, bool_or(b.first < a.first) later
  from both_ways join sets a on a.id = x join sets b on b.id = y group by x)
select l.doc_id, l.line_no, coalesce(first[1], l.doc_id) class_doc, coalesce(first[2], l.line_no)::int class_line,
  coalesce(n_links, 0) n_links, first is not null and (first <> (l.doc_id, l.line_no) or coalesce(later, false)) removed
from lines l left join sets using (s) left join linked using (id)
"""


@query("op6_line_dedup", _LINES)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_lines(table(spark, sf_dir, "documents"))


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


@query("op8_benchmark_leaks")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _escaped_sql(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for control in CONTROL:
        text = f"replace({text}, '{control}', '{control[0]}\\{control[1:]}')"
    return text


_CHATS = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
flagged as (
  select *, lag(r) over w is distinct from r as new from turns window w as (partition by conv_id order by turn nulls first, r, t)),
sums as (
  select conv_id, count(*) n_turns, string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, r, t) told,
    coalesce(string_agg(t, '' order by turn nulls first, r, t) filter (r = 'assistant'), '') loss,
    sum(length({_escaped_sql("t")}) + {len(TEXT)} + case when new then length({_escaped_sql("r")}) + {len(TURN) + len(END)} else 0 end) chars
  from flagged group by conv_id)
select conv_id, n_turns, sha256(told) turns_sha256, length(loss) loss_chars, sha256(loss) loss_sha256, chars::bigint formatted_chars
from sums
"""


@query("op9_chat_format", _CHATS)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(
        "select cast(-1 as bigint) conv_id, cast(turn as bigint) turn, role, text from values"
        " (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]') as t(turn, role, text)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_digests(format_chats(rows))


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    shifted = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ord(x)::bigint)), lambda c, b: {shifted}), 4294967295)"


# States of the role grammar: e nothing yet, s after a system turn, u after a user turn, c after a pair.
_REPAIRS = rf"""
with recursive sent as (
  select conv_id, turn, coalesce(role, ' ') r, coalesce(text, ' ') t,
    {_crc32_sql("coalesce(conv_id::text, ' ') || ':' || coalesce(turn::text, ' ')")} % 20 kind from conversations),
hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else r end r,
    case kind when 1 then '' when 2 then regexp_replace(t, '[.!?]', '', 'g') else t end t
  from sent, unnest(case when kind = 3 then [0, 1] else [0] end) u(copy) where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id, r, t order by n) seen
  from (select *, row_number() over (partition by conv_id order by turn nulls first, r, t) n from hurt)),
faults as (
  select *, case when not regexp_matches(t, '[^\x20\x09-\x0D]') then 'blank' when seen > 1 then 'duplicate'
    when not regexp_matches(t, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else '' end fault,
    lag(left(r, 1)) over (partition by conv_id order by n) || left(r, 1) pair from placed),
arcs(a, terminal, z) as (values ('e', 's', 's'), ('e', 'u', 'u'), ('s', 'u', 'u'), ('c', 'u', 'u'), ('u', 'a', 'c')),
made(a, codes, z) as (
  select unnest(['e', 's', 'u', 'c']), '', unnest(['e', 's', 'u', 'c'])
  union all values ('e', 'u', 'u'), ('e', 'ua', 'c'), ('s', 'u', 'u'), ('s', 'ua', 'c'), ('u', 'a', 'c'), ('c', 'u', 'u')),
edits as (
  select made.a, codes || 'D' codes, '' terminal, 3 * len(codes) + 4 cost, made.z, true dropped from made
  union all select made.a, codes || 'K', terminal, 3 * len(codes), arcs.z, false from made join arcs on made.z = arcs.a
  union all select made.a, codes || upper(terminal), '', 3 * len(codes) + 3, arcs.z, false
    from made join arcs on made.z = arcs.a where terminal in ('u', 'a')),
parses as (
  select distinct conv_id, 0::bigint n, 'e' state, 0::bigint cost, '' audit, '' codes from conversations
  union all
  select conv_id, n, state, best[1], best[2], best[3] from (
    select p.conv_id, f.n, e.z state, min((p.cost + e.cost + case when fault = 'truncated' and not dropped then 3 else 0 end,
      p.audit || translate(e.codes, 'UAua', 'RRII'), p.codes || e.codes)) best
    from parses p join faults f on f.conv_id is not distinct from p.conv_id and f.n = p.n + 1 join edits e on e.a = p.state
    where (dropped or fault in ('', 'truncated')) and (terminal = '' or terminal = left(r, 1))
    group by p.conv_id, f.n, e.z)),
sizes as (
  select c.conv_id, count(n) rows, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
    count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate,
    count(*) filter (fault = 'truncated') truncated, count(*) filter (pair not in ('su', 'ua', 'au')) illegal
  from (select distinct conv_id from conversations) c left join faults f on f.conv_id is not distinct from c.conv_id
  group by c.conv_id),
cheapest as (
  select p.conv_id, min((cost + 3 * len(m.codes), audit || repeat('I', len(m.codes)), p.codes || m.codes)) best
  from parses p join sizes s on s.conv_id is not distinct from p.conv_id and s.rows = p.n join made m on m.a = p.state
  where m.z in ('e', 'c') group by p.conv_id),
pieces as (
  select conv_id, unnest(own) piece, unnest(range(1, len(own) + 1)) n
  from (select conv_id, regexp_extract_all(best[3], '[ua]*[KDUA](?:[ua]+$)?') own from cheapest)),
told as (
  select p.conv_id, string_agg(array_to_string(list_transform(string_split(replace(piece, 'D', ''), ''), lambda c: case c
    when 'u' then 'user:' when 'a' then 'assistant:' when 'K' then r || ':' || t when 'U' then 'user:' || t
    else 'assistant:' || t end), chr(10)), chr(10) order by p.n) repaired
  from pieces p join faults f on f.conv_id is not distinct from p.conv_id and f.n = p.n where piece <> 'D' group by p.conv_id)
select s.conv_id, gaps::bigint gaps, blank, duplicate, truncated, illegal, best[1] cost, best[2] audit,
  sha256(coalesce(repaired, '')) repaired_sha256
from sizes s join cheapest c on c.conv_id is not distinct from s.conv_id
  left join told o on o.conv_id is not distinct from s.conv_id
"""


@query("op11_repair", _REPAIRS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair_digests(repair_conversations(damaged(rows), all_ids=rows))


_TRIE = rf"""
with turns as (
  select conv_id, coalesce(role, '') r, coalesce(text, '') t,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) n from conversations),
told as (select conv_id, list((r, t) order by n) own from turns group by conv_id),
built as (
  select c.conv_id, coalesce(b.own[1:h], []) || c.own[h + 1:] path
  from (select *, coalesce({_crc32_sql("conv_id::text")} % 4, 0) h from told) c left join told b on b.conv_id = c.conv_id - c.conv_id % 20),
steps as (select conv_id, d, path[1:d] path, len(path) many from (select *, unnest(range(0, len(path) + 1)) d from built)),
nodes as (
  select path, d, min(conv_id) conv_id, count(*) n_convs,
    sha256(coalesce(string_agg(conv_id::text, ',' order by conv_id) filter (many = d), '')) ends_sha256,
    (count(*) - 1) * coalesce(len(regexp_extract_all(path[d][2], '[^\x20\x09-\x0D]+')), 0) saved
  from steps group by path, d),
children as (select path[1:d - 1] path, count(*) n_children from nodes where d > 0 group by 1),
full_nodes as (select n.*, coalesce(n_children, 0) n_children from nodes n left join children using (path)),
below as (
  select path[1:k] path, count(*) filter (n_children = 0) n_leaves, sum(saved)::bigint saved_tokens
  from (select *, unnest(range(0, d + 1)) k from full_nodes) group by 1)
select n.conv_id, n.d depth, p.conv_id parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
from full_nodes n join below using (path) left join nodes p on n.d > 0 and p.path = n.path[1:n.d - 1]
"""


@query("op12_prefix_trie", _TRIE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("op13_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
