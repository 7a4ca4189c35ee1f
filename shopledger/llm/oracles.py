"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from shopledger.llm import decontamination as d
from shopledger.llm import sharding as s


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def decontamination() -> str:
    """The contaminated documents, by comparing template windows as text."""
    kind = f"""case when x in ({_list(d.UNITS[:5])}) then '~' when regexp_matches(x, '^\\p{{N}}') then '#'
        when lower(x) = x then case when x in ({_list(d.UNITS)}) then '~' when x in ({_list(d.NUMBER_WORDS)}) then '#' end
        when upper(x) <> x then '@' end"""
    windows = f"""select * exclude (t), t[i + 1 : i + {d.WINDOW}] as words from (
        select *, unnest(range(len(t) - {d.WINDOW - 1})) as i from (
            select *, regexp_extract_all(text, '{d.TOKEN}') as t from {{source}} where length(text) > 0) where len(t) >= {d.WINDOW})"""
    folded = f"case when ({kind}) = '@' then lower(x) else coalesce({kind}, lower(x)) end"
    marked = f"""select * exclude (words), array_to_string(list_transform(words, lambda x: coalesce({kind}, lower(x))), ' ') as mark,
        array_to_string(list_transform(words, lambda x: {folded}), ' ') as plain,
        list_transform(list_filter(words, lambda x: ({kind}) is not null), lambda x: ({kind}) || lower(x)) as slots from ({windows})"""
    pair = "doc_id, text, item_id, item"
    same = " and ".join(f"h.{c} is not distinct from b.{c}" for c in pair.split(", "))
    return f"""with
        items as (select distinct item_id, text, text as item from benchmark),
        docs as (select distinct doc_id, text from documents),
        places as (
            select item_id, item, mark, min(i) as place, arg_min(slots, i) as slots, arg_min(plain, i) as plain from ({marked.replace("{source}", "items")})
            where len(slots) <= {d.WINDOW - d.MIN_LITERALS} group by all),
        sizes as (select item_id, item, count(*) as size from places group by all),
        theirs as (
            select item_id, item, place, mark, slots from places union
            select item_id, item, place, plain, list_filter(slots, lambda x: x[1] <> '@') from places),
        ours as (select distinct doc_id, text, mark, slots as doc_slots from ({marked.replace("{source}", "docs")})
            where mark in (select mark from theirs)),
        hits as (select doc_id, text, t.item_id, t.item, place, slots, doc_slots, size
            from ours join theirs t using (mark) join sizes s on s.item = t.item and s.item_id is not distinct from t.item_id),
        pairs as (select {pair}, unnest(slots) as a, unnest(doc_slots) as o from hits),
        counted as (select {pair}, a, o, count(*) as n from pairs group by all),
        bound as (select {pair}, a, arg_min(o, (-n, o)) as o from counted group by {pair}, a),
        numbered as (select *, row_number() over () as hit from hits),
        wrong as (select distinct hit from (select {pair}, hit, unnest(slots) as a, unnest(doc_slots) as o from numbered) h
            join bound b on {same} and h.a = b.a where h.o <> b.o),
        held as (select {pair}, count(distinct place) as n, count(distinct place) / any_value(size) as coverage
            from numbered where hit not in (select hit from wrong) group by {pair}
            having coverage >= {d.MIN_COVERAGE} or n >= {d.LONG_RUN})
        select doc_id, min(item_id) as first_item, count(distinct item_id) as n_items, max(coverage) as coverage, max(n) as n_windows
        from held group by doc_id, text"""


def embeddings() -> str:
    """Links by all cosines, and the smallest id reachable through them."""
    finite = "list_filter(embedding, lambda x: x is null or not isfinite(x)) = [] and list_filter(embedding, lambda x: x <> 0) <> []"
    return f"""with recursive
        numbered as (select row_number() over () as row, vec_id, embedding::double[] as v, coalesce({finite}, false) as usable from embeddings),
        links as (select a.row as a, b.row as b from numbered a join numbered b on a.row <> b.row and a.usable and b.usable
            and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9),
        reached as (select row, vec_id from numbered union select b, vec_id from reached join links on a = row),
        roots as (select row, min(vec_id) as component_id from reached group by row),
        degrees as (select a as row, count(*) as n_links from links group by a)
        select vec_id, coalesce(n_links, 0) as n_links, component_id, coalesce(vec_id = component_id, false) as kept
        from numbered join roots using (row) left join degrees using (row)"""


def warc() -> str:
    """Sizes and digests of the payloads; a digest's 160 bits are read five at a time."""
    five = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * i + 1, 5))::integer >> {shift}) & 31) + 1, 1)"
    letters = " || ".join(five.format(shift=shift) for shift in (15, 10, 5, 0))
    return f"""with payloads as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
        firsts as (select *, min(page_id) over (partition by payload) as first from payloads)
        select page_id, strlen(payload) as payload_bytes,
        array_to_string(list_transform(range(8), lambda i: {letters}), '') as payload_digest,
        case when page_id is distinct from first then 'revisit' else 'response' end as record_type,
        case when page_id is distinct from first then first end as refers_to from firsts"""


def sharding() -> str:
    """The slot by the digest of the id's text, and the filled table beside it as a literal."""
    shards = ",".join(map(str, s.lookup_table(s.names())))
    return f"""with filled as (select unnest(range({s.SLOTS})) as slot, unnest(string_split('{shards}', ','))::integer as shard),
        placed as (select doc_id, ('0x' || substr(md5(coalesce(doc_id::bigint::varchar, '')), 1, 15))::bigint % {s.SLOTS} as slot
            from documents)
        select doc_id, slot, shard from placed join filled using (slot)"""


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def collocations() -> str:
    """Phrases counted as text, scored in 128-bit whole numbers."""
    return f"""with pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) as piece from (
            select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), {_AZ}) as t from documents)),
        words as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
        totals as (select lang, sum(len(w))::hugeint as n from words group by lang),
        grams as (select lang, size, array_to_string(w[i + 1 : i + size], ' ') as phrase from (
            select *, unnest(range(len(w) - size + 1)) as i from (
                select *, unnest([1, 2, 3, 4, 5]) as size from words) where len(w) >= size)),
        counts as (select lang, size, phrase, count(*)::hugeint as a from grams group by all having count(*) >= 100),
        listed as (select *, string_split(phrase, ' ') as w from counts where size > 1),
        cuts as (select *, array_to_string(w[1 : k], ' ') as x, array_to_string(w[k + 1 :], ' ') as y from (
            select *, unnest(range(1, size)) as k from listed)),
        scores as (select c.lang, c.phrase, c.a, c.k, l.a as l, r.a as r, n, 1000 * c.a * n // (l.a * r.a) as score
            from cuts c join counts l on l.lang = c.lang and l.phrase = x join counts r on r.lang = c.lang and r.phrase = y
            join totals t on t.lang = c.lang),
        worst as (select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        inner_phrases as (select lang, a, array_to_string(w[i + 1 : i + m], ' ') as phrase from (
            select *, unnest(range(size - m + 1)) as i from (select *, unnest(range(2, size)) as m from listed))),
        longest as (select lang, phrase, max(a) as longer from inner_phrases group by all),
        kept as (select w.* from worst w left join longest o on o.lang = w.lang and o.phrase = w.phrase
            where longer is null or 100 * longer < 100 * w.a)
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
            a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
        from kept qualify rank <= 2000"""


def divergence() -> str:
    """Every kept term beside every source of its language."""
    return f"""with docs as (select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
            regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
        places as (select d, lang, source, unnest(w) as term from docs),
        kept as (select lang, term, count(*)::hugeint as c from places group by all having count(distinct d) >= 10),
        langs as (select lang, count(*)::hugeint as v, sum(c)::hugeint as n from kept group by lang),
        groups as (select distinct lang, source from docs),
        counted as (select lang, source, term, count(*)::hugeint as c from places join kept using (lang, term) group by all),
        cells as (select g.lang, g.source, k.term, coalesce(s.c, 0)::hugeint as c from groups g join kept k on k.lang = g.lang
            left join counted s on s.lang = g.lang and s.source = g.source and s.term = k.term),
        sizes as (select lang, source, sum(c)::hugeint as n from cells group by all),
        shares as (select lang, source, term, cells.c as c, 1 + 1000000000 * (cells.c + 2) // (sizes.n + 2 * v) as p,
                1 + 1000000000 * (kept.c + 2) // (langs.n + 2 * v) as q
            from cells join sizes using (lang, source) join langs using (lang) join kept using (lang, term)),
        pairs as (select g.lang, g.source, o.source as item from groups g join groups o on o.lang = g.lang and o.source <> g.source),
        pair_values as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
            from shares a join shares b on b.lang = a.lang and b.term = a.term and b.source <> a.source group by all),
        found as (select lang, source, 'pair' as part, item, coalesce(value, 0)::bigint as value
            from pairs left join pair_values using (lang, source, item)
            union all select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from shares where c > 0 and p > q)
        select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank
        from found qualify part = 'pair' or rank <= 10"""
