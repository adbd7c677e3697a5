"""DuckDB texts of the registered queries, for those that SQL can state."""

from __future__ import annotations

from tte.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, WINDOW

_WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint h
  from documents
), totals as (
  select source, sum(size)::bigint source_size from sized group by source
), ranked as (
  select *, (case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end)::double w,
         (2 * source_size)::double lim, (sum(source_size) over ())::double * 3 / 2 budget
  from totals
), levels as (
  select *, (budget - coalesce(sum(lim) over (order by lim / w, source nulls last rows between unbounded preceding and 1 preceding), 0))
         / (sum(w) over () - coalesce(sum(w) over (order by lim / w, source nulls last rows between unbounded preceding and 1 preceding), 0)) lev
  from ranked
), chosen as (
  select arg_min(lev, (lim / w, coalesce(source, '')) ) lev from levels where lim >= lev * w
), targets as (
  select source, source_size, least(lim, c.lev * w) target,
         case when source_size > 0 then floor(least(lim, c.lev * w) / source_size)::bigint else 0 end reps
  from levels, chosen c
), by_hash as (
  select source, h, sum(size) size, sum(sum(size)) over (partition by source order by h) upto from sized group by source, h
), cut as (
  select t.source, max(case when b.upto - b.size + b.size / 2.0 <= t.target - t.reps * t.source_size then b.h end) top
  from targets t join by_hash b on b.source is not distinct from t.source
  where b.size > 0 and b.upto - b.size < t.target - t.reps * t.source_size group by t.source
)
select s.doc_id, s.size, t.source_size, t.target,
       (s.size * (t.reps + case when s.h <= c.top then 1 else 0 end))::bigint taken
from sized s join targets t on s.source is not distinct from t.source
left join cut c on s.source is not distinct from c.source
"""

_RULE_SQL = " and ".join(f"{measure} {op} {bound}" for measure, op, bound in RULES)
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

QUALITY = rf"""
with base as (
  select row_number() over () rid, doc_id, coalesce(text, '') text from documents
), words as (
  select *, regexp_extract_all(text, '{_WORD}') w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) l from base
), places as (
  select rid, unnest(generate_series(1, len(w) - {WINDOW} + 1)) i, w from words where len(w) >= {WINDOW}
), windows as (
  select rid, i, count(*) over (partition by rid, list_slice(w, i, i + {WINDOW - 1})) n from places
), hits as (
  select rid, least({WINDOW}, coalesce(lead(i) over (partition by rid order by i) - i, {WINDOW})) c from windows where n > 1
), covered as (
  select rid, sum(c)::bigint n_repeat_words from hits group by rid
), measured as (
  select doc_id, len(w)::bigint n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint n_symbols,
         length(regexp_replace(text, '[^!]+', '', 'g'))::bigint n_exclaims,
         len(l)::bigint n_lines, (len(l) - len(list_distinct(l)))::bigint n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint n_repeat_words,
         len(list_filter(w, lambda x: lower(x) in ({_STOP})))::bigint n_stop
  from words left join covered using (rid)
), shares as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words base_failed,
         case when n_words > 0 then word_chars / n_words::double else 0 end mean_word_chars,
         case when n_words > 0 then n_symbols / n_words::double else 0 end symbols_per_word,
         case when n_words > 0 then n_exclaims / n_words::double else 0 end exclaims_per_word,
         case when n_lines > 0 then n_dup_lines / n_lines::double else 0 end dup_line_share,
         case when n_words > 0 then n_repeat_words / n_words::double else 0 end repeat_word_share,
         case when n_words > 0 then n_stop / n_words::double else 0 end stop_word_share
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and {_RULE_SQL} kept
from shares
"""

LEAKS = r"""
with d as (
  select row_number() over () rid, doc_id id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') w
  from documents where doc_id is not null
), b as (
  select item_id id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') w
  from benchmark where item_id is not null
), bs as (
  select distinct id, len(w) n_words, list_slice(w, i, i + least(len(w), 5) - 1) s
  from (select id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) i from b where len(w) > 0)
), lengths as (
  select distinct len(s) m from bs
), ds as (
  select distinct rid, id, list_slice(w, i, i + m - 1) s from (select rid, id, w, m, unnest(generate_series(1, len(w) - m + 1)) i from d, lengths where len(w) >= m)
), n as (
  select id, n_words, count(*) n from bs group by id, n_words
), shared as (
  select ds.rid, ds.id doc_id, bs.id item_id, bs.n_words, count(*) m from ds join bs using (s) group by all
)
select doc_id, item_id, shared.n_words::bigint n_words, max(n)::bigint n_shingles, max(m)::bigint n_shared, max(m / n::double) containment
from shared join n on n.id = item_id and n.n_words = shared.n_words where m >= 0.8 * n group by doc_id, item_id, shared.n_words
"""

WARC = r"""
with p as (
  select page_id, encode(coalesce(html, '')) b from pages
), d as (
  select page_id, octet_length(b)::bigint n, sha1(b) h, sha256(b) s from p
), t as (
  select *, max(page_id) over (partition by s) top from d
)
select page_id, n payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31), 1)), '') payload_digest,
       case when page_id is not distinct from top then 'response' else 'revisit' end record_type,
       case when page_id is distinct from top then top end refers_to
from t
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: crc32 by its table, one byte at a time: the table, and the sum of a text in a query that also reads it.
_CRC_TABLE = """crc_table as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) t
  from range(256) r(i)
)"""


def _crc32(text: str) -> str:
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


#: States of a conversation: 1 nothing yet, 2 after system, 3 after user, 4 after assistant. ``v`` holds the
#: cheapest costs from a row on, by the state before it; costs go backwards, choices forwards.
REPAIR = rf"""
with recursive {_CRC_TABLE}, hashed as (
  select conv_id, turn, coalesce(role, ' ') "role", coalesce(text, ' ') text, {_crc32("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 h
  from conversations, crc_table
), damaged as (
  select conv_id, turn, case when h = 4 then 'user' else "role" end "role",
         case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text,
         unnest(case when h = 3 then [1, 2] else [1] end) copy
  from hashed where h <> 0
), numbered as (
  select conv_id, turn, "role", text, row_number() over (partition by conv_id order by turn nulls first, "role", md5(text)) rn from damaged
), judged as (
  select *, not regexp_matches(text, '[^\x20\x09-\x0D]') blank,
         row_number() over (partition by conv_id, "role", text order by rn) > 1 again,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') cut
  from numbered
), marked as (
  select conv_id, turn, "role", text, rn, case when blank then 2 when again then 3 when cut then 1 else 0 end fault,
         substr("role", 1, 1) k, coalesce(lag(substr("role", 1, 1)) over (partition by conv_id order by rn) || substr("role", 1, 1) not in ('su', 'ua', 'au'), false) bad
  from judged
), summed as (
  select conv_id, count(*) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (fault = 2) blank,
         count(*) filter (fault = 3) duplicate, count(*) filter (fault = 1) truncated, count(*) filter (bad) illegal
  from marked group by conv_id
), costs as (
  select conv_id, n + 1 rn, [0, 10, 5, 0]::bigint[] v from summed
  union all
  select conv_id, rn, [least(b[1], 5 + b[3], 10 + b[4]), least(b[2], 5 + b[3], 10 + b[4]), least(b[3], 5 + b[4]), least(b[4], 5 + b[3])] v from (
    select m.conv_id, m.rn, [
        least(2 + v[1], case when fault > 1 then 99999999 else 5 * fault + least(1 + v[3], case k when 's' then v[2] when 'u' then v[3] else 99999999 end) end),
        least(2 + v[2], case when fault > 1 then 99999999 else 5 * fault + least(1 + v[3], case k when 'u' then v[3] else 99999999 end) end),
        least(2 + v[3], case when fault > 1 then 99999999 else 5 * fault + least(1 + v[4], case k when 'a' then v[4] else 99999999 end) end),
        least(2 + v[4], case when fault > 1 then 99999999 else 5 * fault + least(1 + v[3], case k when 'u' then v[3] else 99999999 end) end)] b
    from costs c join marked m on m.conv_id is not distinct from c.conv_id and m.rn = c.rn - 1)
), steps as (
  select conv_id, 1::bigint rn, 1 s, '' audit, []::varchar[] lines, true go from summed
  union all
  select conv_id, case when e in ('I', '') then rn else rn + 1 end, case e when 'D' then s when '' then s when 'K' then kept else nxt end, audit || e,
         case e when 'K' then list_append(lines, "role" || ':' || text) when 'R' then list_append(lines, name || ':' || text)
                when 'I' then list_append(lines, name || ':') else lines end, e <> ''
  from (
    select w.*, m."role", m.text, case when w.s = 3 then 4 else 3 end nxt, case when w.s = 3 then 'assistant' else 'user' end name,
           case when w.s = 1 and k = 's' then 2 when w.s <> 3 and k = 'u' then 3 when w.s = 3 and k = 'a' then 4 end kept,
           case when m.rn is null then case when now.v[w.s] = 0 then '' else 'I' end
                when 2 + aft.v[w.s] = now.v[w.s] then 'D'
                when 5 + now.v[case when w.s = 3 then 4 else 3 end] = now.v[w.s] then 'I'
                when fault < 2 and 5 * fault + aft.v[case when w.s = 1 and k = 's' then 2 when w.s <> 3 and k = 'u' then 3 when w.s = 3 and k = 'a' then 4 end] = now.v[w.s] then 'K'
                else 'R' end e
    from steps w join costs now on now.conv_id is not distinct from w.conv_id and now.rn = w.rn
    left join costs aft on aft.conv_id is not distinct from w.conv_id and aft.rn = w.rn + 1
    left join marked m on m.conv_id is not distinct from w.conv_id and m.rn = w.rn
    where w.go)
)
select b.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate,
       coalesce(truncated, 0)::bigint truncated, coalesce(illegal, 0)::bigint illegal, coalesce(c.v[1], 0)::bigint "cost",
       coalesce(w.audit, '') audit, sha256(coalesce(array_to_string(w.lines, chr(10)), '')) repaired_sha256
from (select distinct conv_id from conversations) b
left join summed s on s.conv_id is not distinct from b.conv_id
left join costs c on c.conv_id is not distinct from b.conv_id and c.rn = 1
left join steps w on w.conv_id is not distinct from b.conv_id and not w.go
"""

VARIANTS = rf"""
with recursive {_CRC_TABLE}, runs as (
  select coalesce(doc_id::varchar, '') k, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), '{_UPPER}', '{_LOWER}') run from documents
), counted as (
  select k, run, count(*) c from runs group by all
), hashed as (
  select run, c, {_crc32("(k || ':' || run)")} h from counted, crc_table
), words as (
  select case when h % 31 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end word, sum(c)::bigint n
  from hashed group by 1 having sum(c) >= 2 and length(word) >= 7
), shorter as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) s from (select word, n, unnest(range(1, length(word) + 1)) i from words)
), near as (
  select a.word, b.word other, b.n from shorter a join shorter b on a.s = b.s and a.i = b.i and a.word <> b.word
  union
  select a.word, b.word, b.n from words a join shorter b on a.word = b.s
  union
  select b.word, a.word, a.n from words a join shorter b on a.word = b.s
), best as (
  select word, count(*) n_near, max(n) top, min(other) filter (n = m) form
  from (select *, max(n) over (partition by word) m from near) group by word
), forms as (
  select w.word, w.n, coalesce(n_near, 0) n_near, case when top >= 10 * w.n then form end form, case when top >= 10 * w.n then top end form_n
  from words w left join best b on w.word = b.word
), chains as (
  select word, form root from forms where form is not null
  union all
  select c.word, f.form from chains c join forms f on f.word = c.root where f.form is not null
)
select f.word, f.form, coalesce(r.root, f.word) root, f.n, f.n_near::bigint n_near, f.form_n
from forms f left join (select c.word, c.root from chains c join forms f on f.word = c.root where f.form is null) r on r.word = f.word
"""
