"""DuckDB SQL for the corpus queries that SQL can express whole. The verdicts of the others hang on sampled
paths, tokenizer merges, mined rules, trained models or floating distances; tests hold those to other
versions."""

from __future__ import annotations

ORACLES = {
    "op8_warc": """
        with raw as (select page_id, coalesce(html, '') as html from pages),
        sized as (select *, octet_length(encode(html)) as size, sha1(html) as digest from raw),
        again as (
            select digest, max(page_id) as kept from sized where size >= 1000 and page_id is not null
            group by digest having count(*) > 1
        )
        select page_id, cast(size as bigint) as payload_bytes, digest as payload_digest,
            case when page_id <> kept then 'revisit' else 'response' end as record_type,
            case when page_id <> kept then kept end as refers_to
        from sized left join again using (digest)
    """,
    "op13_collocations": r"""
        with texts as (
            select row_number() over () as doc, coalesce(lang, 'und') as lang, coalesce(text, '') as text from documents
        ),
        pieces as (
            select lang, unnest(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
            )) as piece from texts
        ),
        worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
        totals as (select lang, sum(len(words)) as n from worded group by lang),
        placed as (
            select lang, words, size, unnest(range(1, len(words) - size + 2)) as pos
            from worded cross join (select unnest(range(1, 6)) as size)
        ),
        counts as (
            select lang, size, words[pos : pos + size - 1] as phrase, count(*) as f from placed
            group by all having count(*) >= 100
        ),
        cuts as (
            select c.lang, c.size, c.phrase, c.f as a, x.f as l, y.f as r, n, k,
                (1000::hugeint * c.f * n) // (x.f::hugeint * y.f) as score
            from counts c join totals using (lang) cross join (select unnest(range(1, 5)) as k)
            join counts x on x.lang = c.lang and x.phrase = c.phrase[1 : k]
            join counts y on y.lang = c.lang and y.phrase = c.phrase[k + 1 : c.size]
            where c.size > 1 and k < c.size
        ),
        lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        inside as (
            select lang, f, unnest(list_distinct(flatten([
                [phrase[i : i + m - 1] for i in range(1, size - m + 2)] for m in range(2, size)
            ]))) as phrase
            from counts where size > 2
        ),
        kept as (
            select * from lowest t where not exists (
                select 1 from inside i where i.lang = t.lang and i.phrase = t.phrase and 100 * i.f >= 100 * t.a
            )
        ),
        ranked as (
            select lang, array_to_string(phrase, ' ') as phrase, a, l, r, n, score from kept
        )
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
            a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
        from ranked qualify rank <= 2000
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
