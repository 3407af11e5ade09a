"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from . import mixing, quality
from .rows import UPPER, WORD

ORACLES: dict[str, str] = {}

ORACLES["op8_exact_dedup"] = f"""
with d as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') as norm from documents),
     g as (select norm, max(doc_id) as keep_id, count(*) as group_size from d group by norm)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from d join g using (norm)"""

# A word of a text, as in the library, for regular expressions of either engine.
_WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"

ORACLES["op9_source_mixing"] = f"""
with d as (select doc_id, source, len({_WORDS}) as size, md5(concat('{mixing.SEED}:', cast(doc_id as varchar))) as seeded
           from documents),
     s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
     p as (select *, row_number() over (order by source is null, source) - 1 as place from s),
     w as (select *, list_value(5, 2, 1)[place % 3 + 1] as weight from p),
     t as (select cast(sum(source_size) as double) as total, cast(sum(weight) as double) as all_weights from w),
     -- Sources by the rate at which they are full: the first that is not full when those before it are.
     o as (select *, row_number() over full_order as turn,
                  coalesce(sum(source_size) over (full_order rows between unbounded preceding and 1 preceding), 0) as full_size,
                  coalesce(sum(weight) over (full_order rows between unbounded preceding and 1 preceding), 0) as full_weight
           from w window full_order as (order by 2e0 * source_size / weight, place)),
     r as (select (1.5e0 * total - 2 * cast(full_size as double)) / (all_weights - cast(full_weight as double)) as rate, *
           from o, t),
     k as (select rate from r where rate * weight <= 2 * source_size order by turn limit 1),
     g as (select source, place, source_size,
                  case when k.rate * weight > 2 * source_size then cast(2 * source_size as double) else k.rate * weight end as target
           from w, k),
     e as (select d.*, g.place, g.source_size, g.target,
                  cast(concat('0x', substr(seeded, 1, 8)) as bigint) % ((g.source_size - 1) // {mixing.SHARD_WORDS} + 1) as shard
           from d join g on d.source is not distinct from g.source),
     c as (select place, shard, cast(sum(size) as bigint) as words, max(target) * sum(size) / max(source_size) as wanted
           from e where size > 0 group by place, shard),
     c2 as (select *, cast(floor(wanted / {mixing.BLOCK_WORDS} + 0.5) as bigint) as rounded from c),
     m as (select cast(floor(1.5e0 * (select total from t) / {mixing.BLOCK_WORDS} + 0.5) as bigint) - sum(rounded) as missing,
                  count(*) as n_cells, sum(wanted) as all_wanted from c2),
     c3 as (select c2.*, missing, cast(ceil(wanted / all_wanted * (abs(missing) + n_cells)) as bigint) + 1 as seats from c2, m),
     f as (select place, shard, wanted, missing,
                  unnest(case when missing > 0 then generate_series(rounded + 1, rounded + seats)
                              else generate_series(greatest(rounded - seats, 1), rounded) end) as seat from c3),
     f2 as (select *, row_number() over (order by case when missing > 0 then -wanted / (2 * seat - 1) else wanted / (2 * seat - 1) end,
                                                  sign(missing) * seat, sign(missing) * place, sign(missing) * shard) as turn from f),
     h as (select place, shard, count(*) as n from f2 where turn <= abs(missing) group by place, shard),
     q as (select c3.*, least((rounded + coalesce(n, 0) * sign(missing)) * {mixing.BLOCK_WORDS}, 2 * words) as quota
           from c3 left join h using (place, shard)),
     q2 as (select place, shard, words, quota // words as copies, quota - quota // words * words as rest from q),
     b as (select *, unnest(generate_series(0, (words - 1) // {mixing.BLOCK_WORDS})) as block from q2 where rest > 0),
     b2 as (select *, least({mixing.BLOCK_WORDS}, words - block * {mixing.BLOCK_WORDS}) as block_size,
                   md5(concat('{mixing.SEED}:', place, ':', shard, ':', block)) as seeded from b),
     b3 as (select *, least(block_size, rest - coalesce(sum(block_size) over (
                   partition by place, shard order by seeded, block rows between unbounded preceding and 1 preceding), 0)) as take from b2),
     i as (select *, coalesce(sum(size) over (
                   partition by place, shard order by seeded rows between unbounded preceding and 1 preceding), 0) as first
           from e where size > 0),
     j as (select i.doc_id, sum(greatest(0, least(first + size, block * {mixing.BLOCK_WORDS} + take)
                                            - greatest(first, block * {mixing.BLOCK_WORDS}))) as partly
           from i join b3 on i.place = b3.place and i.shard = b3.shard and take > 0
                and block between first // {mixing.BLOCK_WORDS} and (first + size - 1) // {mixing.BLOCK_WORDS}
           group by i.doc_id)
select e.doc_id, e.size, e.source_size, e.target,
       cast(case when e.size = 0 then 0 else copies * e.size + coalesce(partly, 0) end as bigint) as taken
from e left join q2 on e.place = q2.place and e.shard = q2.shard and e.size > 0 left join j on e.doc_id = j.doc_id"""



def _without(text: str, pattern: str) -> str:
    return "length(regexp_replace({}, '{}', '', 'g'))".format(text, pattern.replace("'", "''"))


_CLASSES = ", ".join(f"length(residue) - {_without('residue', pattern)}" for pattern in quality.CLASSES.values())
_NO_CLASS = _without("residue", "|".join(quality.CLASSES.values()))
_COMMON = ", ".join(f"len(list_filter(w, lambda x: x = '{word}'))" for word in quality.VOCABULARY)
_N_CLASSES, _N_COMMON = len(quality.CLASSES) + 3, len(quality.VOCABULARY) + 1

ORACLES["op5_quality_rules"] = f"""
with d as (select doc_id, lang, coalesce(text, '') as text, {_WORDS} as w from documents),
     j as (select *, array_to_string(w, '') as joined from d),
     r as (select *, regexp_replace(joined, '{quality.LOWER}', '', 'g') as residue,
                  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) as lines from j),
     g as (select doc_id, unnest(range(1, len(w) - 1)) as i, w from r where len(w) >= 3),
     g2 as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n from g),
     v as (select doc_id, count(distinct word) as n_repeat_words
           from (select doc_id, unnest([i, i + 1, i + 2]) as word from g2 where n > 1) group by doc_id),
     c as (select doc_id, lang, length(text) as n_chars, len(w) as n_words, length(joined) as word_chars,
                  length(joined) - {_without("joined", quality.CLASSES["symbol"])} as n_symbols,
                  len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
                  [length(text) - length(joined), length(joined) - length(residue), {_CLASSES}, {_NO_CLASS}] as classes,
                  [{_COMMON}] as known
           from r left join v using (doc_id)),
     bins as (select doc_id, lang, unnest(list_concat(classes, known, [n_words - cast(list_sum(known) as bigint)])) as n,
                     unnest(range({_N_CLASSES + _N_COMMON})) as bin from c),
     shares as (select *, bin < {_N_CLASSES} as of_class, n / sum(n) over (partition by doc_id, bin < {_N_CLASSES}) as p from bins),
     langs as (select lang, bin, bin < {_N_CLASSES} as of_class, sum(n) as n from bins
               where lang in ({", ".join(f"'{lang}'" for lang in quality.COMMON_WORDS)}) group by lang, bin),
     refs as (select *, n / sum(n) over (partition by lang, of_class) as q from langs),
     parts as (select s.doc_id, s.of_class, refs.lang,
                      (case when p > 0 then p * log2(2 * p / (p + q)) else 0 end
                       + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2 as part
               from shares s join refs using (bin) where not isnan(p)),
     far as (select doc_id, of_class, lang, sqrt(greatest(sum(part), 0)) as distance from parts group by doc_id, of_class, lang),
     near as (select doc_id, min(distance) filter (of_class) as class_distance, min(distance) filter (not of_class) as word_distance
              from far group by doc_id),
     b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c left join near using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and not (n_chars >= {quality.Limits().min_chars} and coalesce(class_distance, 0) > {quality.Limits().class_distance})
       and not (n_words >= {quality.Limits().min_words} and coalesce(word_distance, 0) > {quality.Limits().word_distance}) as kept
from b"""


def _crc32(text: str, table: str) -> str:
    """Unsigned CRC-32 of the UTF-8 of a text, by the 256 values of :data:`_CRC_TABLE`."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: cast('0x' || substr({digits}, 2 * cast(i as integer) + 1, 2) as bigint))"
    step = f"xor(c >> 8, {table}[(xor(c, octet) & 255) + 1])"
    return f"xor(4294967295, list_reduce({octets}, lambda c, octet: {step}, 4294967295::bigint))"


_CRC_TABLE = """select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, bit:
                       case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, cast(b as bigint))) as crc_of"""

ORACLES["op12_importance_resampling"] = f"""
with k as ({_CRC_TABLE}),
     w as (select rid, doc_id, unnest(words) as word
           from (select row_number() over () as rid, doc_id,
                        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
                 from documents)),
     y as (select unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word
           from benchmark),
     b as (select word, {_crc32("word", "crc_of")} % 10000 as bucket
           from (select word from w union select word from y), k),
     s as (select bucket, count(*) as s from w join b using (word) group by bucket),
     t as (select bucket, count(*) as t from y join b using (word) group by bucket),
     g as (select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1) * cast((select count(*) from w) + 10000 as double)
                  / ((s + 1) * cast((select count(*) from y) + 10000 as double)))) as bigint) as gain
           from s left join t using (bucket)),
     d as (select doc_id, count(*) as n_features, cast(sum(gain) as bigint) as weight
           from w join b using (word) join g using (bucket) group by rid, doc_id),
     a as (select documents.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight
           from documents left join d on documents.doc_id = d.doc_id),
     e as (select *, weight + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) + 0.5e0)
                  / 4294967296e0))) as bigint) as score from a),
     r as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place from e)
select doc_id, n_features, weight, score,
       case when n_features >= 20 and place <= (select count(*) from e where n_features >= 20) * 10 // 100 then place end as rank
from r"""

ORACLES["op11_spelling_variants"] = f"""
with recursive k as ({_CRC_TABLE}),
     o as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) as run
           from documents),
     d as (select doc_id, run, count(*) as n from o where length(run) >= 7 group by doc_id, run),
     h as (select run, n, {_crc32("doc_id || ':' || run", "crc_of")} as h from d, k),
     r as (select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from h),
     w as (select word, cast(sum(n) as bigint) as n from r where length(word) >= 7 group by word having sum(n) >= 2),
     p as (select word, n, unnest(range(1, length(word) + 1)) as i from w),
     -- A letter replaced: the same rest around the same place. A letter deleted: the rest is a word.
     c as (select word, n, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail from p),
     e as (select a.word, b.word as other, b.n as other_n from c a join c b on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word
           union select c.word, w.word, w.n from c join w on w.word = head || tail
           union select w.word, c.word, c.n from c join w on w.word = head || tail),
     b as (select word, count(*) as n_near, max(other_n) as form_n from e group by word),
     f as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 10 * w.n then form_n end as form_n from w left join b using (word)),
     g as (select f.word, min(e.other) as form from f join e on e.word = f.word and e.other_n = f.form_n group by f.word),
     t(word, root, steps) as (select word, word, 0 from w union all select t.word, g.form, steps + 1 from t join g on g.word = t.root),
     l as (select word, arg_max(root, steps) as root from t group by word)
select f.word, g.form, l.root, f.n, f.n_near, f.form_n from f left join g using (word) join l using (word)"""
