"""The queries SQL can express, for DuckDB over the same tables."""

from viewtide.llm.systematic_mix import offset

_WORDS = r"'[^\x20\x09-\x0D]+'"
_SPACES = r"'[\x20\x09-\x0D]'"

_NEAREST = """
            found{n} as (
                select rn, p, arg_min(j, d * 64 + j) as j, min(d) as d
                from (
                    select c.rn, c.p, e.j, sum((c.x - e.x) * (c.x - e.x)) as d
                    from component c join entry{n} e on e.p = c.p and e.k = c.k group by all
                ) group by rn, p
            )"""
_MEANS = """
            entry{m} as (
                select e.p, e.j, e.k, coalesce(cast(floor(cast(s.total as double) / s.n) as bigint), e.x) as x
                from entry{n} e left join (
                    select f.p, f.j, c.k, sum(c.x) as total, count(*) as n
                    from found{n} f join component c on c.rn = f.rn and c.p = f.p group by all
                ) s on s.p = e.p and s.j = e.j and s.k = e.k
            )"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_systematic_mix": f"""
            with recursive sized as (
                select doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) as size from documents
            ), totals as (
                select source, cast(sum(size) as bigint) as source_size,
                       (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
                from sized group by source
            ), turns as (
                -- turn by turn, sources above their limit are held at it and the rest is shared anew
                select 0 as turn, source, source_size, weight, cast(null as double) as held from totals
                union all
                select turn + 1, source, source_size, weight,
                       case when held is not null then held
                            when weight * (rest / open_weight) > 3 * source_size then 3.0 * source_size end
                from (
                    select *, cast(sum(source_size) over () as double) - coalesce(sum(held) over (), 0) as rest,
                           sum(case when held is null then weight end) over () as open_weight
                    from turns
                ) where turn <= (select count(*) from totals)
            ), final as (
                select *, cast(sum(source_size) over () as double) - coalesce(sum(held) over (), 0) as rest,
                       sum(case when held is null then weight end) over () as open_weight
                from turns where turn = (select count(*) from totals)
            ), targets as (
                select source, source_size, coalesce(held, weight * (rest / open_weight)) as target from final
            ), placed as (
                select s.doc_id, s.size, t.source_size, t.target,
                       row_number() over (partition by s.source order by s.size, s.doc_id nulls last) as k,
                       case when t.source_size > 0 then t.target / t.source_size else 0 end as e
                from sized s join targets t on s.source is not distinct from t.source
            )
            select doc_id, cast(size as bigint) as size, source_size, target,
                   cast(size * (floor(k * e + {offset()}) - floor((k - 1) * e + {offset()})) as bigint) as taken
            from placed
        """,
        "op7_warc": """
            with hashed as (
                select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages
            ), coded as (
                -- 20 bits at a time: five digits of base 16, four of base 32
                select *, min(page_id) over (partition by payload) as first_id,
                       array_to_string([
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
                               ((cast('0x' || hex[5 * (i // 4) + 1 : 5 * (i // 4) + 5] as bigint)
                                 >> (15 - 5 * (i % 4))) & 31) + 1]
                           for i in range(32)], '') as payload_digest
                from hashed
            )
            select page_id, cast(strlen(payload) as bigint) as payload_bytes, payload_digest,
                   case when page_id = first_id then 'response' else 'revisit' end as record_type,
                   case when page_id <> first_id then first_id end as refers_to
            from coded
        """,
        "op10_content_sort": f"""
            with normal as (
                select doc_id, length(coalesce(text, '')) as points,
                       sha256(regexp_replace(coalesce(text, ''), {_SPACES}, '', 'g')) as text_sha256
                from documents
            )
            select doc_id, text_sha256,
                   first_value(doc_id) over best as keep_id,
                   count(*) over (partition by text_sha256) as group_size,
                   row_number() over best = 1 as kept
            from normal
            window best as (partition by text_sha256 order by points desc, doc_id)
        """,
        "op11_gnat_codes": f"""
            with whole as (
                select vec_id, label, row_number() over (order by vec_id nulls last, embedding) as rn,
                       list_transform(embedding, lambda v: cast(floor(256 * cast(v as double)) as bigint)) as xs
                from embeddings
                where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
            ), component as (
                select rn, (i - 1) // (len(xs) // 16) as p, (i - 1) % (len(xs) // 16) as k, xs[i] as x
                from (select rn, xs, unnest(range(1, len(xs) + 1)) as i from whole)
            ), entry0 as (select p, rn - 1 as j, k, x from component where rn <= 64),
            {_NEAREST.format(n=0)}, {_MEANS.format(m=1, n=0)}, {_NEAREST.format(n=1)}, {_MEANS.format(m=2, n=1)},
            {_NEAREST.format(n=2)},
            coded as (
                select rn, string_agg(printf('%02x', j), '' order by p) as code, cast(sum(d) as bigint) as error
                from found2 group by rn
            )
            select vec_id, label, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
                   (select sha256(string_agg(cast(x as varchar), ',' order by p, j, k)) from entry2) as codebooks_sha256
            from whole join coded using (rn)
        """,
    }
