"""DuckDB SQL of the queries that SQL can express."""

_WORDS5 = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP5 = f"""
with dd as (select row_number() over () rn, doc_id, coalesce({_WORDS5}, []) w from documents),
bb as (select distinct coalesce(item_id::varchar, '') it, {_WORDS5} w from benchmark where text is not null),
bw as (select distinct it, n, array_to_string(w[s:s + n - 1], ' ') win
       from (select it, w, least(13, len(w)) n, unnest(range(1, len(w) - least(13, len(w)) + 2)) s from bb where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (select rn, n, s, array_to_string(w[s:s + n - 1], ' ') win
       from (select rn, w, n, unnest(range(1, len(w) - n + 2)) s from dd, sizes where len(w) >= n)),
hit as (select distinct rn, it, n, s from dw join bw using (n, win)),
pos as (select rn, count(distinct p) n_hit from (select rn, unnest(range(s, s + n)) p from hit) group by rn),
its as (select rn, count(*) n_items, string_agg(it, ',' order by it) ids from (select distinct rn, it from hit) group by rn)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) contaminated
from dd left join pos using (rn) left join its using (rn)
"""

# The budget tree of op4: each level dealt by weight, full children first.
# Levels: (parent columns, column); every weight is 100, two epochs, budget 600/1000, seed 7.


def _deal(level: str, parents: list[str], above: str) -> str:
    keys = ", ".join(["root", *parents])
    by = f"partition by {keys} order by ratio, {level}"
    return f"""
{level}_n as (select {keys}, {level}, sum(cap)::hugeint cap, any_value(a.budget)::hugeint budget
              from leaf join {above} a using ({keys}) group by {keys}, {level}),
{level}_r as (select *, cap * 1000000 // 100 ratio from {level}_n),
{level}_f as (select *, cap * (100 * count(*) over (partition by {keys}) - 100 * (row_number() over ({by}) - 1))
                     <= greatest(budget - coalesce(sum(cap) over ({by} rows between unbounded preceding and 1 preceding), 0), 0) * 100 as is_full from {level}_r),
{level}_g as (select *, case when is_full then cap else
                greatest(budget - sum(case when is_full then cap else 0 end) over (partition by {keys}), 0) * 100
                // (100 * sum(case when is_full then 0 else 1 end) over (partition by {keys})) end::hugeint got from {level}_f),
{level}_l as (select *, least(budget, sum(cap) over (partition by {keys})) - sum(got) over (partition by {keys}) loss,
                sum(case when got < cap then 1 else 0 end) over ({by} rows between unbounded preceding and current row) turn from {level}_g),
{level}_b as (select {keys}, {level}, got + case when got < cap and turn <= loss then 1 else 0 end as budget from {level}_l)"""


OP4 = f"""
with doc as (select row_number() over () no, doc_id,
        'domain' || (coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') as bigint), 0) % 4)::varchar as domain,
        coalesce(lang, '(null)') lang, coalesce(source, '(null)') source,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint n_tokens from documents),
d as (select * from doc where n_tokens > 0),
leaf as (select 0 root, domain, lang, source, sum(n_tokens)::hugeint tokens, (2 * sum(n_tokens))::hugeint cap, count(*) docs from d group by domain, lang, source),
top as (select 0 root, (coalesce(sum(tokens), 0) * 600 // 1000)::hugeint budget from leaf),
{_deal("domain", [], "top")},{_deal("lang", ["domain"], "domain_b")},{_deal("source", ["domain", "lang"], "lang_b")},
plan as (select domain, lang, source, (b.budget // tokens)::bigint whole, (b.budget % tokens)::bigint part
         from leaf join source_b b using (root, domain, lang, source)),
e as (select d.*, whole, part from d join plan using (domain, lang, source)),
fulls as (select doc_id, domain, lang, source, n_tokens, unnest(range(1, whole + 1))::int epoch from e where whole > 0),
lasts as (select *, (whole + 1)::int epoch, ('0x' || substr(md5('7:' || (whole + 1)::varchar || ':' || coalesce(doc_id::varchar, '')), 1, 15))::bigint k from e where part > 0),
run as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source order by k, no rows between unbounded preceding and 1 preceding), 0) spent from lasts)
select doc_id, domain, lang, source, n_tokens, epoch from fulls
union all select doc_id, domain, lang, source, n_tokens, epoch from run where spent < part
"""

# The same tree with unequal weights on every level; a name that is not listed weighs 100.
MIX_WEIGHTS = {"domain": {"domain0": 400, "domain2": 50}, "lang": {"en": 200, "fr": 25}, "source": {"src1": 500, "src4": 20, "src6": 250}}


def _deal_weighted(level: str, parents: list[str], above: str) -> str:
    keys = ", ".join(["root", *parents])
    weight = " ".join(f"when '{name}' then {w}" for name, w in MIX_WEIGHTS[level].items())
    by = f"partition by {keys} order by ratio, {level}"
    earlier = f"over ({by} rows between unbounded preceding and 1 preceding)"
    return f"""
{level}_n as (select {keys}, {level}, (case {level} {weight} else 100 end)::hugeint w, sum(cap)::hugeint cap, any_value(a.budget)::hugeint budget
              from leaf join {above} a using ({keys}) group by {keys}, {level}),
{level}_r as (select *, cap * 1000000 // w ratio from {level}_n),
{level}_f as (select *, cap * (sum(w) over (partition by {keys}) - coalesce(sum(w) {earlier}, 0))
                     <= greatest(budget - coalesce(sum(cap) {earlier}, 0), 0) * w as is_full from {level}_r),
{level}_g as (select *, case when is_full then cap else
                greatest(budget - sum(case when is_full then cap else 0 end) over (partition by {keys}), 0) * w
                // (sum(case when is_full then 0 else w end) over (partition by {keys})) end::hugeint got from {level}_f),
{level}_l as (select *, least(budget, sum(cap) over (partition by {keys})) - sum(got) over (partition by {keys}) loss,
                sum(case when got < cap then 1 else 0 end) over ({by} rows between unbounded preceding and current row) turn from {level}_g),
{level}_b as (select {keys}, {level}, got + case when got < cap and turn <= loss then 1 else 0 end as budget from {level}_l)"""


MIXING_WEIGHTED = OP4
for _level, _parents, _above in (("domain", [], "top"), ("lang", ["domain"], "domain_b"), ("source", ["domain", "lang"], "lang_b")):
    MIXING_WEIGHTED = MIXING_WEIGHTED.replace(_deal(_level, _parents, _above), _deal_weighted(_level, _parents, _above))

# op11: integer vectors, sixteen seeds, three rounds, a last assignment.


def _nearest(no: int) -> str:
    return f"""
pair{no} as (select row_id, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint dist from kept, cent{no}),
near{no} as (select row_id, arg_min(k, (dist, k)) k, min(dist) dist from pair{no} group by row_id)"""


def _moved(no: int) -> str:
    """Means of round ``no``, rounded down exactly."""
    return f"""
sums{no} as (select k, i, sum(v[i])::hugeint s, count(*) n from near{no} join kept using (row_id), range(1, 65) r(i) group by k, i),
mean{no} as (select k, list(((s - ((s % n) + n) % n) // n)::bigint order by i) c from sums{no} group by k),
cent{no + 1} as (select k, coalesce(m.c, o.c) c from cent{no} o left join mean{no} m using (k))"""


OP11 = f"""
with raw as (select row_number() over () row_id, vec_id, embedding e from embeddings where len(embedding) = 64),
kept as (select row_id, vec_id, list_transform(e, lambda x: floor(64 * x::double)::bigint) v from raw
         where len(list_filter(e, lambda x: x is not null and isfinite(x))) = 64),
cent0 as (select row_number() over (order by h, v) - 1 k, v c
          from (select v, sha256('1:' || coalesce(vec_id::varchar, '')) h from kept order by h, v limit 16)),
{",".join(_nearest(i) + "," + _moved(i) for i in range(3))},{_nearest(3)},
inert as (select k, sum(dist)::bigint ci from near3 group by k)
select vec_id, k::int as cluster, dist as distance, ci cluster_inertia, (select sum(dist) from near3)::bigint inertia,
       sha256(array_to_string(c, ',')) centroid_sha256
from near3 join kept using (row_id) join inert using (k) join cent3 using (k)
"""

# op12: levels of runs of eight; a tree that is down to one node stays as it is.
TREE_LEVELS, LANG_LEVELS = 8, 3


def _climb(name: str, key: str, levels: int) -> str:
    """Node tables ``{name}0..{levels}(key, pos, d, n)`` and, for each level,
    ``{name}r{i}(key, run, ds, n)`` with the nodes of each run."""
    out = []
    for i in range(levels):
        out.append(f"""
{name}r{i} as (select {key}, pos // 8 run, list(d order by pos) ds, any_value(n) n from {name}{i} group by {key}, pos // 8),
{name}{i + 1} as (select {key}, run pos, case when n > 1 then sha256(array_to_string(ds, '')) else ds[1] end d,
                  count(*) over (partition by {key}) n from {name}r{i})""")
    return ",".join(out)


def _fold(name: str, key: str, levels: int, start: str) -> str:
    """From ``start(rn, key, pos, d, sib)``: the digest and the siblings above."""
    out, last = [], start
    for i in range(levels):
        out.append(f"""
{name}f{i} as (select f.rn, f.{key}, f.pos // 8 pos,
     case when r.n > 1 then sha256(array_to_string(ds[:f.pos % 8], '') || d || array_to_string(ds[f.pos % 8 + 2:], '')) else d end d,
     sib || case when r.n > 1 then array_to_string(ds[:f.pos % 8], '') || array_to_string(ds[f.pos % 8 + 2:], '') else '' end sib
     from {last} f join {name}r{i} r on r.{key} = f.{key} and r.run = f.pos // 8)""")
        last = f"{name}f{i}"
    return ",".join(out)


_PART = "case when {0} is null then '-' else strlen({0}::varchar)::varchar || ':' || {0}::varchar end"
_HEAD = " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# crc32 bit by bit, over the bits of the bytes of the decimal id
_BITS = ("flatten(list_transform(string_split(coalesce(doc_id::varchar, ''), ''), "
         "lambda c: list_transform(range(8), lambda b: ((ord(c)::bigint >> b) & 1)::bigint)))")
_CRC = (f"xor(list_reduce(list_prepend(4294967295::bigint, {_BITS}), lambda c, b: "
        "xor(c >> 1, case when xor(c, b) & 1 = 1 then 3988292384::bigint else 0::bigint end)), 4294967295::bigint)")

OP12 = f"""
with doc as (select row_number() over () rn, doc_id, lang, sha256({_HEAD} || {_PART.format("text")}) leaf,
       case when {_CRC} % 3 = 0 then sha256({_HEAD} || {_PART.format(_LOWERED)}) end tampered from documents),
lng as (select lang, row_number() over (order by lang nulls first) - 1 tree from (select distinct lang from documents)),
item as (select rn, doc_id, leaf, tampered, tree, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 pos,
         count(*) over (partition by tree) n from doc join lng on doc.lang is not distinct from lng.lang),
t0 as (select tree, pos, leaf d, n from item),{_climb("t", "tree", TREE_LEVELS)},
l0 as (select 0 one, tree pos, d, count(*) over () n from t{TREE_LEVELS}),{_climb("l", "one", LANG_LEVELS)},
start_t as (select rn, tree, pos, coalesce(tampered, leaf) d, '' sib from item),{_fold("t", "tree", TREE_LEVELS, "start_t")},
start_l as (select rn, 0 one, tree pos, d, sib from tf{TREE_LEVELS - 1}),{_fold("l", "one", LANG_LEVELS, "start_l")}
select doc_id, leaf, s.d subroot, r.d root, sha256(f.sib) proof_sha256, f.d folded_root, f.d = r.d verified
from lf{LANG_LEVELS - 1} f join item using (rn) join t{TREE_LEVELS} s on s.tree = item.tree, l{LANG_LEVELS} r
"""

OP13 = """
with rules as (select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) t(rh, rp, rv)),
rest as (select row_number() over () rn, page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end r from pages),
cut as (select rn, page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) path from rest),
hit as (select rn, arg_max(rh || rp, length(rh) + length(rp)) rule, arg_max(rv, length(rh) + length(rp)) rv
        from cut join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by rn)
select page_id, host, path, rule, coalesce(rv, 'allow') verdict from cut left join hit using (rn)
"""

ORACLE_SQL = {"op4_mixing": OP4, "mixing_weighted": MIXING_WEIGHTED, "op5_decontaminate": OP5, "op11_centroids": OP11, "op12_merkle": OP12, "op13_urls": OP13}
