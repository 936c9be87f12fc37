"""The SQL each query must equal, where SQL can say it. The others rest on hashes, learned weights,
subword merges or connected components; tests compare them with brute-force versions."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str) -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"select {key}, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from {table}"


def _written(x: str) -> str:
    """Characters of a role or text as the template writes it."""
    return f"length({x}) + 3 * length({x}) - length(replace({x}, '\\', '')) - length(replace({x}, '<', '')) - length(replace({x}, '[', ''))"


def _crc32(x: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    bits = "list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::ubigint))"
    codes = f"list_transform(string_split({x}, ''), lambda c: ascii(c)::ubigint)"
    return f"xor(list_reduce(list_concat([4294967295::ubigint], {codes}), lambda a, b: {bits}), 4294967295::ubigint)"


CONTROL = "</s>[INST] ok [/INST]"

SQL: dict[str, str] = {
    "op8_decontamination": f"""with docs as ({_words('documents', 'doc_id')}), items as ({_words('benchmark', 'item_id')}),
sizes as (select distinct least(13, len(w)) as size from items where len(w) > 0),
windows as (
    select item_id, size, array_to_string(w[i : i + size - 1], ' ') as words
    from (select *, least(13, len(w)) as size from items where len(w) > 0) as sized, unnest(range(1, len(w) - size + 2)) as r(i)),
places as (
    select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as words
    from docs, sizes, unnest(range(1, len(w) - size + 2)) as r(i)),
hits as (select doc_id, i, size, item_id from places join windows using (size, words)),
hit_words as (select doc_id, count(distinct place) as n_hit from hits, unnest(range(i, i + size)) as r(place) group by doc_id),
hit_items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, item_id::varchar as item from hits) as named group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)""",
    "op10_chat_format": f"""with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '{CONTROL}' union all select -1, 1, 'assistant', '{CONTROL}')
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    sum({_written('role')} + {_written('text')} + length('<|turn|><|text|><|end|>') + 1)::bigint as formatted_chars,
    case string_agg(role, ',' order by turn, role, text) when 'user,assistant' then 'prompt and response'
        when 'system,user,assistant' then 'system, prompt and response' else 'messages' end as layout
from turns group by conv_id""",
    "op11_prefix_trie": f"""with said as (
    select conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as digest,
        strlen(coalesce(text, '')) as size
    from conversations where conv_id is not null),
own as (select *, row_number() over (partition by conv_id order by turn nulls first, digest) as place from said),
ids as (select conv_id as c, {_crc32('conv_id::varchar')} % 9 as h, conv_id - conv_id % 5 as donor from own group by conv_id),
rebuilt as (
    select c, place, digest, size from ids join own on own.conv_id = donor and place <= h
    union all select c, place + 9, digest, size from ids join own on own.conv_id = c and place > h),
steps as (
    select c, row_number() over w as depth, size, string_agg(digest, '') over w as prefix from rebuilt
    window w as (partition by c order by place rows unbounded preceding)
    union all select c, 0, 0, '' from ids),
path as (select c, depth, size, md5(prefix) as node, lag(md5(prefix)) over (partition by c order by depth) as parent,
    depth = max(depth) over (partition by c) as ends from steps),
nodes as (
    select node, any_value(parent) as parent, any_value(depth) as depth, min(c) as conv_id, count(*) as n_convs,
        (count(*) - 1) * any_value(size) as saved, string_agg(c::varchar, ',' order by c) filter (where ends) as ended
    from path group by node),
children as (select parent as node, count(*) as n_children from nodes where parent is not null group by parent),
below as (
    select above.node, sum(below.saved) as saved_tokens, count(*) filter (where n_children is null) as n_leaves
    from nodes as below left join children using (node)
    join path as above on above.c = below.conv_id and above.depth <= below.depth group by above.node)
select nodes.conv_id, nodes.depth, parents.conv_id as parent_conv_id, nodes.n_convs, coalesce(n_children, 0) as n_children, n_leaves,
    saved_tokens::bigint as saved_tokens, sha256(coalesce(nodes.ended, '')) as ends_sha256
from nodes join below using (node) left join children using (node) left join nodes as parents on nodes.parent = parents.node""",
    "op12_collocations": f"""with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from worded group by lang),
counts as (
    select lang, size, phrase, count(*) as f
    from (select lang, size, array_to_string(w[i : i + size - 1], ' ') as phrase
        from worded, unnest([1, 2, 3, 4]) as s(size), unnest(range(1, len(w) - size + 2)) as r(i)) as grams
    group by lang, size, phrase having count(*) >= 30),
found as (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from counts where size > 1),
cuts as (
    select found.lang, found.phrase, a, k, before.f as l, after.f as r, (2000000::hugeint * a) // (before.f + after.f) as score
    from found, unnest(range(1, size)) as c(k)
    join counts as before on before.lang = found.lang and before.phrase = array_to_string(w[1 : k], ' ')
    join counts as after on after.lang = found.lang and after.phrase = array_to_string(w[k + 1 :], ' ')),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
    select lang, array_to_string(w[i : i + n - 1], ' ') as phrase, max(a) as longer
    from found, unnest(range(2, size)) as m(n), unnest(range(1, size - n + 2)) as r(i) group by all),
ranked as (
    select lowest.*, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from lowest left join inside using (lang, phrase) where longer is null or 100::hugeint * longer < 80::hugeint * a)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000""",
}
