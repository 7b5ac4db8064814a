"""SQL for the results of the queries that SQL can express."""

from __future__ import annotations

import re

from topicflow.llm import licenses

_ORACLES: dict[str, str] = {}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


_ORACLES["op1_url_filter"] = r"""
with urls as (
    select page_id,
        case when url is null or position('://' in url) = 0 then ''
            else translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end as host,
        case when url is null or position('://' in url) = 0 then ''
            else regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') end as path
    from pages),
rules(verdict, rule_host, rule_path) as (
    values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits as (
    select host, path, max({'n': length(rule_host || rule_path), 'verdict': verdict, 'rule': rule_host || rule_path}) as best
    from (select distinct host, path from urls), rules
    where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by host, path)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict
from urls left join fits using (host, path)
"""  # noqa: E501

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


def _words(pattern: str) -> str:
    return f"coalesce(regexp_extract_all({LOWER.format('text')}, '{pattern}'), [])"


_ORACLES["op3_near_duplicates"] = f"""
with recursive docs as (
    select row_number() over () as r, doc_id, {_words(SPACED)} as w from documents),
sets as (
    select r, doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as s from docs),
shingles as (select r, len(s) as n, unnest(s) as x from sets),
links as (
    select a.r as a, b.r as b from shingles a join shingles b on a.x = b.x and a.r <> b.r
    group by a.r, b.r, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(a, b) as (
    select r, r from sets union select reach.a, links.b from reach join links on reach.b = links.a),
components as (select reach.a as r, min(s.doc_id) as component_id from reach join sets s on s.r = reach.b group by 1)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sets join components using (r)
"""

_ORACLES["op6_decontamination"] = f"""
with docs as (select row_number() over () as r, doc_id, {_words(PLAIN)} as w from documents),
items as (
    select cast(item_id as varchar) as item, w, least(10, len(w)) as n
    from (select item_id, {_words(PLAIN)} as w from benchmark where item_id is not null) where len(w) > 0),
windows as (
    select distinct item, n, array_to_string(w[i + 1:i + n], ' ') as x
    from (select item, w, n, unnest(range(len(w) - n + 1)) as i from items)),
places as (
    select r, n, i, array_to_string(w[i + 1:i + n], ' ') as x
    from (select r, w, n, unnest(range(len(w) - n + 1)) as i
          from docs, (select distinct n from windows) where len(w) >= n)),
hits as (select r, i, p.n as n, item from places p join windows using (n, x)),
covered as (
    select r, count(distinct pos) as n_hit
    from (select r, unnest(range(i, i + n)) as pos from (select distinct r, i, n from hits)) group by r),
found as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct r, item from hits) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (r) left join found using (r)
"""


def _license_sql() -> str:
    known = ", ".join(
        "({}, '{}')".format(n, " ".join(re.findall(r"[^\W_]+", text.lower()))) for n, text in licenses.SENTENCES.items()
    )
    rules = ", ".join(f"('{name}', {len(ids)}, '{','.join(map(str, ids))}')" for name, ids in licenses.RULES)
    mark = "chr(1)"
    cut = rf"regexp_replace(text, '([.;!?])[ \t]+', '\1' || {mark}, 'g')"
    cut = rf"regexp_replace({cut}, '[\r\n]+', {mark}, 'g')"
    cut = rf"regexp_replace({cut}, '\),[ \t]*', ')' || {mark}, 'g')"
    return rf"""
with known(sentence_id, sentence) as (values {known}),
rules(license, n, ids) as (values {rules}),
cut as (select row_number() over () as r, doc_id, string_split({cut}, {mark}) as parts from documents),
sentences as (
    select r, doc_id, unnest(range(len(parts))) as place,
        trim(regexp_replace(lower(unnest(parts)), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) as sentence from cut),
found as (
    select r, doc_id, list({{'place': place, 'id': sentence_id}} order by place) as k
    from sentences join known using (sentence) group by r, doc_id),
starts as (select r, doc_id, k, unnest(range(len(k))) as pos from found),
matched as (
    select r, doc_id, pos, k[pos + 1].place as place, arg_min({{'license': license, 'n': n, 'ids': ids}}, (-n, license)) as best
    from starts join rules on array_to_string([x.id for x in k[pos + 1:pos + n]], ',') = ids
    group by all),
ended as (
    select *, max(pos + best.n) over (
        partition by r order by pos rows between unbounded preceding and 1 preceding) as reach from matched)
select doc_id, best.license as license, cast(place as integer) as place, cast(best.n as integer) as n_sentences,
    best.ids as sentence_ids
from ended where reach is null or reach < pos + best.n
"""


_ORACLES["op10_license_scan"] = _license_sql()

_ORACLES["op11_ball_search"] = f"""
with docs as materialized (select row_number() over () as r, doc_id, {_words(PLAIN)} as w from documents),
whole as (select count(*) as docs, sum(len(w)) as total from docs where len(w) > 0),
counted as materialized (
    select r, doc_id, term, count(*) as tf, n from (select r, doc_id, len(w) as n, unnest(w) as term from docs) group by all),
weights as materialized (
    select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as weight
    from (select term, count(*) as df from counted group by term), whole),
asked as materialized (
    select distinct q, item_id, term from (
        select row_number() over () as q, item_id, unnest({_words(PLAIN)}) as term from benchmark)),
scored as (
    select q, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) as score
    from asked join counted using (term) join weights using (term), whole group by all having score > 0)
select item_id, cast(rank as int) as rank, doc_id, cast(score as bigint) as score from (
    select *, row_number() over (partition by q order by score desc, doc_id, r) as rank from scored) where rank <= 10
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain rounds of full scans."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} as materialized (
    select r, p, min({{'d': d, 'e': e}}) as best from (
        select x.r, x.p, c.e, sum((x.v - c.v) * (x.v - c.v)) as d from x join c{k} c on x.p = c.p and x.i = c.i group by all)
    group by r, p)""")
        if k < rounds:
            steps.append(f"""
c{k + 1} as materialized (
    select c.p, c.e, c.i, case when n is null then c.v else (s - ((s % n) + n) % n) // n end as v
    from c{k} c left join (
        select x.p, best.e as e, i, sum(v) as s, count(*) as n from x join a{k} using (r, p) group by all) m
        on c.p = m.p and c.e = m.e and c.i = m.i)""")
    return f"""
with kept as materialized (
    select row_number() over (order by vec_id) as r, vec_id, label, embedding as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda z: z is null or not isfinite(z))) = 0),
x as materialized (
    select r, (j - 1) // (len(v) // {parts}) as p, (j - 1) % (len(v) // {parts}) as i,
        cast(floor(cast(v[j] as double) * 4096) as hugeint) as v
    from (select r, v, unnest(range(1, len(v) + 1)) as j from kept)),
c0 as materialized (select p, r - 1 as e, i, v from x where r <= {entries}),
{",".join(steps)},
books as (select sha256(string_agg(cast(v as varchar), ',' order by p, e, i)) as h from c{rounds}),
codes as (
    select r, string_agg(printf('%02x', best.e), '' order by p) as code, cast(sum(best.d) as bigint) as error
    from a{rounds} group by r)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h as codebooks_sha256
from codes join kept using (r), books
"""


_ORACLES["op13_vector_codes"] = _vector_codes()
