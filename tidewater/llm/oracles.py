"""DuckDB SQL for the operator queries that SQL can express.

The others have none: their XXH64 and CRC-32 values, pseudorandom permutations
and fitted models have no SQL form in DuckDB.  They are tested against
brute-force versions, exact round trips or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

ORACLES = {
    # SHA-1 in hex, five digits (20 bits) at a time, to base32
    "op4_warc_index": """
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
     d as (select *, array_to_string(list_transform(range(0, 32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
                   (cast('0x' || substr(h, 1 + 5 * (i // 4), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as int), 1)), '')
               as digest, min(page_id) over (partition by body) as first from p)
select page_id, cast(strlen(body) as bigint) as payload_bytes, digest as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to from d""",
    # all windows of 100 bytes, as hex
    "op5_repeated_bytes": """
with t as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
     w as (select doc_id, s, substr(x, 1 + 2 * s, 200) as v
           from (select doc_id, x, unnest(range(0, length(x) // 2 - 99)) as s from t)),
     r as (select doc_id, s from (select doc_id, s, row_number() over (partition by v order by doc_id, s) as k from w)
           where k > 1),
     g as (select doc_id, s, sum(new) over (partition by doc_id order by s) as run
           from (select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as new
                 from r)),
     u as (select doc_id, run, min(s) as a, max(s) + 100 as b from g group by doc_id, run),
     k as (select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as before from u),
     o as (select t.doc_id, t.x, count(k.a) as n_spans, coalesce(sum(k.b - k.a), 0) as n_removed,
                  coalesce(string_agg(substr(t.x, 1 + 2 * k.before, 2 * (k.a - k.before)), '' order by k.a), '')
                  || substr(t.x, 1 + 2 * coalesce(max(k.b), 0)) as kept
           from t left join k on t.doc_id = k.doc_id group by t.doc_id, t.x)
select doc_id, cast(length(x) // 2 as bigint) as n_bytes, cast(n_removed as bigint) as n_removed,
       cast(n_spans as bigint) as n_spans, sha256(unhex(kept)) as kept_sha256 from o""",
    # one piece a step, the longest that fits, for every distinct word
    "op8_wordpiece_counts": r"""
with recursive v as (select hex(from_base64(piece)) as h
                     from read_csv('/opt/tokenizers/byte_bpe_50k.tiktoken', delim=' ', header=false, quote='', escape='',
                                   columns={'piece': 'varchar', 'rank': 'bigint'})),
     sizes as (select distinct length(h) as l from v),
     d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
     w as (select r, '20' || hex(encode(unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))) as x from d),
     m as (select distinct x, 1 as at, 0 as n from w
           union all
           select m.x, m.at + max(s.l), m.n + 1
           from m join sizes s on m.at + s.l <= length(m.x) + 1 join v on v.h = substr(m.x, m.at, s.l)
           group by m.x, m.at, m.n),
     c as (select x, max(n) as n from m group by x)
select d.doc_id, cast(strlen(any_value(d.text)) as bigint) as n_bytes, count(c.n) as n_words,
       cast(coalesce(sum(c.n), 0) as bigint) as n_tokens, cast(0 as bigint) as n_unknown,
       cast(coalesce(max(c.n), 0) as bigint) as longest_word_tokens
from d left join w on w.r = d.r left join c on c.x = w.x group by d.r, d.doc_id""",
}
