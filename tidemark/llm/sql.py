"""The queries that SQL can express, as SQL over the same tables."""

_UNIFORM = "(('0x' || substr(md5('mix:count:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0"



def _crc32(bytes_: str) -> str:
    """Unsigned CRC-32 of a list of bytes, bit by bit: -1 stands for one shift."""
    steps = f"flatten(list_transform({bytes_}, lambda byte: [byte, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (
        f"xor(list_reduce(list_prepend(4294967295::bigint, {steps}), lambda crc, x: case when x >= 0 then xor(crc, x) "
        "else xor(crc >> 1, (crc & 1) * 3988292384) end), 4294967295::bigint)"
    )


def _utf8(text: str) -> str:
    """UTF-8 bytes of a text without code points above U+07FF."""
    return (
        f"flatten(list_transform(string_split({text}, ''), lambda c: case when ord(c) < 128 then [ord(c)::bigint] "
        "else [192 + (ord(c) >> 6)::bigint, 128 + (ord(c) & 63)::bigint] end))"
    )


CHECKS: dict[str, str] = {
    "op3_chat_formatting": """
with recursive a as (
  select conv_id, 'call-' || turn call_id, turn, text, case role when 'user' then 'respond' else 'configure' end tool,
         case when role = 'user' then 'call-' || (case when turn = 1 then 0 else turn - 2 end) end needs,
         (case when role = 'user' then json_object('chars', length(text), 'prompt', text) else json_object('rules', text) end)::varchar arguments
  from conversations where role in ('user', 'system') and conv_id is not null and turn is not null),
c as (select * from a qualify row_number() over (partition by conv_id, call_id order by tool, arguments) = 1),
r as (select conv_id, 'call-' || (turn - 1) call_id, text result, true answered from conversations where role = 'assistant' and turn is not null
      qualify row_number() over (partition by conv_id, turn order by text nulls first) = 1),
d as (select c.conv_id, c.call_id, 0::bigint depth from c left join c up on up.conv_id = c.conv_id and up.call_id = c.needs where up.call_id is null
      union all select c.conv_id, c.call_id, d.depth + 1 from c join d on d.conv_id = c.conv_id and d.call_id = c.needs),
v as (select c.*, depth, result, answered,
             coalesce(case tool when 'respond' then length(text) between 1 and 256 else length(text) <= 300 end, false) valid
      from c join d using (conv_id, call_id) left join r using (conv_id, call_id))
select conv_id, call_id, turn, depth, valid, case when not valid then 'invalid' when answered is null then 'open' else 'linked' end status,
       json_object('arguments', arguments, 'call_id', call_id, 'result', result, 'tool', tool)::varchar json
from v
""",
    "op11_prefix_trie": f"""
with t as (select conv_id, turn, coalesce(text, '') x, coalesce(role, '') r from documents_of_turns),
s as (select conv_id, list(s order by turn nulls first, s) turns
      from (select conv_id, turn, md5(length(r) || ':' || r || x) || printf('%016x', length(x)) s from t) group by conv_id),
b as (select o.conv_id, {_crc32(_utf8("o.conv_id::varchar"))} % 6 h, o.turns own, coalesce(base.turns, []) head
      from s o left join s base on base.conv_id = o.conv_id - o.conv_id % 100),
p as (select conv_id, list_concat(head[1:h], own[h + 1:]) turns from b),
m as (select conv_id, d, len(turns) size, turns[1:d] prefix, turns[1:d - 1] up from (select *, unnest(range(0, len(turns) + 1)) d from p)),
n as (select prefix, d depth, any_value(case when d > 0 then up end) up, min(conv_id) conv_id, count(*) n_convs,
             sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = d), '')) ends_sha256
      from m group by prefix, d),
k as (select up, count(*) n_children from n where depth > 0 group by up),
w as (select n.*, coalesce(k.n_children, 0) n_children,
             case when depth = 0 then 0 else (n_convs - 1) * ('0x' || substr(prefix[depth], 33))::bigint end own_saved
      from n left join k on k.up = n.prefix),
a as (select prefix[1:d] prefix, sum(own_saved) saved, count(*) filter (where n_children = 0) n_leaves
      from (select *, unnest(range(0, depth + 1)) d from w) group by all)
select w.conv_id, w.depth::bigint depth, q.conv_id parent_conv_id, w.n_convs, w.n_children, a.n_leaves, a.saved::bigint saved_tokens, w.ends_sha256
from w join a on a.prefix = w.prefix left join w q on w.depth > 0 and q.prefix = w.up
""".replace("documents_of_turns", "conversations where conv_id is not null"),
    "op12_spelling_variants": f"""
with r as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) run
           from documents),
c as (select doc_id, run, count(*) n from r group by all),
h as (select run, n, coalesce({_crc32(_utf8("doc_id || ':' || run"))}, 1) h from c),
e as (select case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end word, n from h),
v as (select word, sum(n)::bigint n from e group by word having length(word) >= 6 and sum(n) >= 5),
x as (select word, n, i, left(word, i) || substr(word, i + 2) less from (select *, unnest(range(0, length(word)))::int i from v)),
y as (select a.word, b.word near, b.n near_n from x a join x b on a.i = b.i and a.less = b.less and a.word <> b.word
      union select a.word, b.word, b.n from x a join v b on a.less = b.word
      union select b.word, a.word, a.n from x a join v b on a.less = b.word),
z as (select word, count(*) n_near, arg_min(near, (-near_n, near)) best, max(near_n) best_n from y group by word),
f as (select v.word, v.n, coalesce(n_near, 0) n_near, case when best_n >= 5 * v.n then best end form, case when best_n >= 5 * v.n then best_n end form_n
      from v left join z on z.word = v.word),
g as (with recursive up(word, root) as (select word, word from f union select up.word, f.form from up join f on f.word = up.root where f.form is not null)
      select up.word, up.root from up join f on f.word = up.root where f.form is null)
select f.word, form, root, n, n_near, form_n from f join g on g.word = f.word
""",
    # The repetition count is the number of k whose cumulated probability stays below the hash.
    "op5_source_mixing": f"""
with n as (select source, count(*) n_docs from documents group by source),
r as (select source, sqrt(n_docs) / (select sum(sqrt(n_docs)) from n) * (select sum(n_docs) from n) / n_docs rate from n),
p as (select source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) below
      from r, lateral (select unnest(range(0, (rate + 40 * sqrt(rate) + 60)::bigint)) k)),
d as (select doc_id, source, {_UNIFORM} u from documents),
c as (select doc_id, d.source, u, (select count(*) from p where p.source is not distinct from d.source and p.below < u) reps from d),
e as (select doc_id, source, unnest(range(0, reps)) copy from c)
select doc_id, source, copy::int copy, md5('mix:place:' || coalesce(doc_id::varchar, 'null') || ':' || copy) shuffle_key from e
""",
}
