"""DuckDB SQL for the queries of this subpackage that SQL can express."""

#: A list of the 256 steps of CRC-32; and the checksum of ASCII or UTF-8 text, byte by byte, over that list.
CRC_TABLE = "select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as steps from range(256) r(i)"
CRC = "xor(list_reduce(list_transform(range(1, octet_length(encode({0})) + 1), lambda k: cast('0x' || substr(hex(encode({0})), 2 * k - 1, 2) as bigint)), lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8), cast(4294967295 as bigint)), 4294967295)"

SQL: dict[str, str] = {
    "op7_warc_normaliser": """
with p as (
    select page_id, coalesce(octet_length(encode(html)), 0) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
    select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first_id from p
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id = first_id then null else first_id end as refers_to
from f
""",
    "op11_spelling_variants": f"""
with recursive crc as ({CRC_TABLE}),
runs as (
    select cast(doc_id as varchar) as id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents
), seen as (
    select id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from runs where length(run) >= 5 group by all
), hashed as (
    select run, n, {CRC.format("(coalesce(id, '') || ':' || run)")} as h from seen, crc
), damaged as (
    select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed
), words as (
    select word, cast(sum(n) as bigint) as n, length(word) as size from damaged where length(word) >= 5 group by word having sum(n) >= 3
), cuts as (
    select word, n, k, substr(word, 1, k) as head, substr(word, k + 2) as tail from (select word, n, unnest(range(size)) as k from words)
), pairs as (
    select a.word as a, a.n as n_a, b.word as b, b.n as n_b from cuts a join cuts b on a.k = b.k and a.head = b.head and a.tail = b.tail and a.word <> b.word
    union select c.word, c.n, w.word, w.n from cuts c join words w on c.head || c.tail = w.word
    union select w.word, w.n, c.word, c.n from cuts c join words w on c.head || c.tail = w.word
), around as (
    select a as word, any_value(n_a) as n, count(*) as n_near, max(n_b) as most from pairs group by a
), forms as (
    select r.word, min(p.b) as form, any_value(r.most) as form_n from around r join pairs p on p.a = r.word and p.n_b = r.most where r.most >= 2 * r.n group by r.word
), chains as (
    select word, form as last from forms union all select c.word, f.form from chains c join forms f on f.word = c.last
), ends as (
    select word, last as root from chains where last not in (select word from forms)
)
select w.word, w.n, coalesce(r.n_near, 0) as n_near, f.form, f.form_n, coalesce(e.root, w.word) as root
from words w left join around r using (word) left join forms f using (word) left join ends e using (word)
""",
    "op13_prefix_trie": f"""
with recursive crc as ({CRC_TABLE}),
turns as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first) - 1 as no, coalesce(role, '') as role, coalesce(text, '') as text from conversations
), convs as (
    select conv_id, conv_id - conv_id % 20 as base, {CRC.format("cast(conv_id as varchar)")} % 4 as h from (select distinct conv_id from conversations), crc
), parts as (
    select c.conv_id, 0 as part, t.no, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.no < c.h
    union all select c.conv_id, 1, t.no, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id and t.no >= c.h
), placed as (
    select conv_id, row_number() over (partition by conv_id order by part, no) as depth, sha256(role || chr(0) || text) as own, len(regexp_extract_all(text, '[^ \\t-\\r]+')) as words from parts
), paths as (
    select conv_id, cast(0 as bigint) as depth, '' as path, cast(null as varchar) as up, cast(0 as bigint) as words from convs
    union all select p.conv_id, p.depth, sha256(q.path || p.own), q.path, p.words from paths q join placed p on p.conv_id = q.conv_id and p.depth = q.depth + 1
), ends as (
    select path, string_agg(cast(conv_id as varchar), ',' order by conv_id) as ids from (select conv_id, arg_max(path, depth) as path from paths group by conv_id) group by path
), nodes as (
    select depth, path, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words from paths group by depth, path
), kids as (
    select up, count(*) as n from nodes where depth > 0 group by up
), below as (
    select path as top, path from nodes union all select b.top, n.path from below b join nodes n on n.up = b.path and n.depth > 0
), sums as (
    select b.top, sum(case when k.n is null then 1 else 0 end) as n_leaves, sum((n.n_convs - 1) * n.words) as saved from below b join nodes n on n.path = b.path left join kids k on k.up = n.path group by b.top
)
select n.conv_id, cast(n.depth as bigint) as depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0) as n_children, cast(s.n_leaves as bigint) as n_leaves,
       cast(s.saved as bigint) as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n left join nodes u on u.path = n.up and n.depth > 0 left join kids k on k.up = n.path left join ends e on e.path = n.path join sums s on s.top = n.path
""",
}
