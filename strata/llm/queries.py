"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    chat, collocations, jaccard, licenses, maxscore, mixing, neighbours, packing, prefix_trie, quality, secrets, toxicity, warc,
)
from strata.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """The public byte-level tokenizer that is installed on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(spark, table(spark, sf_dir, "pages"))


@query
def op2_line_first_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_failed_lines", "chars_lost",
    )


@query
def op3_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


@query
def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query
def op5_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.report(table(spark, sf_dir, "embeddings"))


@query
def op6_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


@query
def op7_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(table(spark, sf_dir, "documents"))


@query
def op10_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query
def op12_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.report(table(spark, sf_dir, "embeddings"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_W = r"'[^\x20\x09-\x0D]+'"


def _count(expr: str, pattern: str) -> str:
    return f"len(regexp_extract_all({expr}, {pattern}))"


_LOW = f"translate(x, '{quality.UPPER}', '{quality.LOWER}')"
_FAILS = f"""(
    (NOT regexp_matches(x, {_sql(quality.SENTENCE_END)}) AND {_count('x', _W)} >= 3)
    OR {_count('x', _sql(quality.DECORATED))} > {quality.MAX_MARKED} * {_count('x', _W)}
    OR ({_count('x', _sql(quality.SEPARATOR))} >= 2 AND {_count('x', _sql(quality.SEPARATOR))} > 0.15 * {_count('x', _W)})
    OR regexp_matches({_LOW}, {_sql('|'.join(quality.BOILERPLATE))}))"""

ORACLES["op1_warc_round_trip"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f,
             payload_bytes >= {warc.LEAST_REVISIT} AND row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) > 1 AS again FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN f END AS refers_to
FROM f"""

ORACLES["op2_line_first_cleaning"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, {_W}) AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_W})) AS ls FROM d),
one AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT rid, i, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS g,
               lead(i, 4) OVER o AS last FROM one WINDOW o AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win WHERE last IS NOT NULL) WHERE n > 1),
cov AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n
        FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM rep) GROUP BY rid),
good AS (SELECT rid, list_filter(ls, lambda x: NOT {_FAILS}) AS g FROM w),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, len(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (len(t) - len(regexp_replace(t, '{quality.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(g))::BIGINT AS n_failed_lines,
             len(coalesce(array_to_string(ls, ''), ''))::BIGINT AS line_chars, len(coalesce(array_to_string(g, ''), ''))::BIGINT AS kept_chars
      FROM w JOIN good USING (rid) LEFT JOIN cov USING (rid)),
v AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND line_chars - kept_chars <= {quality.MAX_LOST} * line_chars) AS kept,
       n_lines, n_failed_lines, line_chars - kept_chars AS chars_lost
FROM v"""

ORACLES["op3_snapshot_collapse"] = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
           FROM conversations),
c AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY pos) AS turns, count(*) AS n FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, turns, n FROM c GROUP BY turns, n),
k AS (SELECT a.* FROM u a WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.turns[1] = a.turns[1] AND b.n > a.n AND b.turns[1:a.n] = a.turns))
SELECT conv_id, ((t.pos - 1) // {chat.PART_TURNS})::INT AS part, k.n::INT AS n_turns,
       string_agg('{chat.OPEN}' || r || '|>' || chr(10) || x || chr(10), '' ORDER BY t.pos) AS rendered
FROM k JOIN t USING (conv_id) GROUP BY conv_id, part, k.n"""


def _spans_sql(no: int) -> str:
    name, pattern, group, least = secrets.KINDS[no]
    mixed = " AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[0-9][^0-9]*[0-9]')" if name == "mixed" else ""
    p = _sql(pattern)
    return f"""SELECT rid, {no} AS k, e - len(m) AS s, e, v FROM (
        SELECT rid, m, v, sum(len(g) + len(m)) OVER (PARTITION BY rid ORDER BY i) AS e FROM (
            SELECT rid, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[1:len(ms)]) AS g FROM (
                SELECT rid, regexp_extract_all(t, {p}) AS ms, regexp_extract_all(t, {p}, {group}) AS vs, string_split_regex(t, {p}) AS gs
                FROM d WHERE regexp_matches(t, {p})))) WHERE len(v) >= {least}{mixed}"""


def _listed_sql(where: str) -> str:
    names = "[" + ", ".join(_sql(k[0]) for k in secrets.KINDS) + "]"
    return f"string_agg({names}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (WHERE {where})"


ORACLES["op4_secret_ownership"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
f AS MATERIALIZED ({' UNION ALL '.join(_spans_sql(no) for no in range(len(secrets.KINDS)))}),
a AS MATERIALIZED (SELECT * FROM f WHERE k < {secrets.BASE} OR NOT EXISTS (
    SELECT 1 FROM f b WHERE b.rid = f.rid AND b.k < {secrets.BASE} AND b.s < f.e AND f.s < b.e)),
o AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS n, count(DISTINCT {{'o': coalesce(source, chr(0)), 'r': coalesce(doc_id::VARCHAR, '')}}) AS m
      FROM a JOIN d USING (rid) GROUP BY v),
j AS (SELECT a.*, n, m, n <= {secrets.MAX_OWNERS} AND m <= {secrets.MAX_REPOS} AS live FROM a JOIN o USING (v)),
p AS (SELECT rid, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
             {_listed_sql(f'k < {secrets.BASE}')} AS base, {_listed_sql(f'k < {secrets.BASE} OR live')} AS spans,
             count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example, max(n) AS most_owners, max(m) AS most_repos FROM j GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example,
       coalesce(most_owners, 0)::BIGINT AS most_owners, coalesce(most_repos, 0)::BIGINT AS most_repos
FROM d LEFT JOIN p USING (rid)"""

_HEX = lambda e: f"('0x' || {e})::BIGINT"
ORACLES["op6_systematic_mix"] = f"""
WITH z AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_W}))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM z GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, {list(map(float, mixing.WEIGHTS))}[rank % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS weight, {mixing.CAP} * source_size AS most FROM r),
f AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total,
             coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS fullsum,
             sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS opened FROM w),
v AS (SELECT *, (total - fullsum) / opened AS lv FROM f),
l AS (SELECT arg_min(lv, {{'a': most / weight, 'b': rank}}) AS lv FROM v WHERE lv * weight <= most),
t AS (SELECT source, source_size, least(most::DOUBLE, weight * l.lv) AS target,
             {_HEX(f"substr(md5('{mixing.SEED}:' || coalesce(source, '')), 1, 8)")}::DOUBLE / 4294967296.0 AS u FROM w, l),
n AS (SELECT z.*, row_number() OVER (PARTITION BY source ORDER BY floor(ln(size + 1) * {mixing.FINENESS}),
             substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2), size, doc_id) AS no FROM z),
c AS (SELECT n.doc_id, size, source_size, target,
             (floor(u + rate * no) - floor(u + rate * (no - 1)))::BIGINT AS copies
      FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t) t JOIN n ON n.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c"""


def _canonical_sql(x: str) -> str:
    """Words of a lower-case text without owner lines."""
    e = f"trim(regexp_replace({x}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F\\x{{2010}}-\\x{{2027}}\\x{{00A0}}]+', ' ', 'g'), ' ')"
    for other, ours in licenses.SPELLINGS:
        e = f"replace({e}, {_sql(other)}, {_sql(ours)})"
    return e


def _owner_line_sql(x: str, alone: str) -> str:
    """Does a lower-case line name an owner? RE2 looks neither ahead nor behind,
    so each rule is a pattern of the line; ``alone`` tells whether the line is a
    paragraph by itself."""
    m = lambda p: f"regexp_matches({x}, {_sql(p)})"
    named = lambda start: f"{m(start + '[ \\t]+[^ \\t\\r\\n]')} AND NOT {m(start + f'[ \\t]+({licenses.NO_OWNER})')}"
    mark = r"^[ \t]*(copyright|\(c\))[ \t,:]*(©|&copy;|\(c\)|by[ \t]|[\[{<(]?([0-9]{4}|yyyy|year)([^a-z0-9]|$))"
    return f"""({m('^[ \\t]*©')} OR {m(mark)} OR ({named(r'^[ \t]*\(c\)[ \t]*copyright')}) OR ({alone} AND {named(r'^[ \t]*copyright')}))"""


_BLANK = "regexp_matches({}, '^[ \\t\\r]*$')"
_ALONE = f"(i = 1 OR {_BLANK.format('ls[i - 1]')}) AND (i = len(ls) OR {_BLANK.format('ls[i + 1]')})"
_KNOWN = ", ".join(f"({_sql(d)}, {_sql(n)})" for d, n in licenses.known_digests().items())
ORACLES["op10_license_digest"] = f"""
WITH known(digest, license) AS (VALUES {_KNOWN}),
d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), chr(10)) AS ls FROM documents),
k AS (SELECT rid, doc_id, array_to_string(list_filter(ls, lambda z, i: NOT {_owner_line_sql('z', _ALONE)}), ' ') AS x FROM d),
c AS (SELECT rid, doc_id, sha256({_canonical_sql('x')}) AS digest FROM k),
l AS (SELECT rid, unnest(ls) AS z FROM d),
m AS (SELECT rid, sha256({_canonical_sql(f"CASE WHEN {_owner_line_sql('z', 'true')} THEN '' ELSE z END")}) AS digest FROM l),
n AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM m JOIN known USING (digest) GROUP BY rid)
SELECT doc_id, digest, license, coalesce(notices, '') AS notices FROM c LEFT JOIN known USING (digest) LEFT JOIN n USING (rid)"""

ORACLES["op11_prefix_trie"] = f"""
WITH bits(n, c) AS (SELECT n, list_reduce(list_prepend(n, generate_series(1, 8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
               FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS n)),
crc(tab) AS (SELECT list(c ORDER BY n) FROM bits),
o AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY pos) AS ts FROM o GROUP BY c),
h AS (SELECT c, ts, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
             lambda a, d: xor(a >> 8, tab[(xor(a, d) & 255) + 1])), 4294967295) % {prefix_trie.HEADS} AS h FROM l, crc),
b AS (SELECT h.c, list_concat(coalesce(list_slice(l.ts, 1, h), []), list_slice(h.ts, h + 1, len(h.ts))) AS ts
      FROM h LEFT JOIN l ON l.c = h.c - h.c % {prefix_trie.GROUP}),
m AS (SELECT c, d, ts[1:d] AS p, len(ts) AS n FROM (SELECT *, unnest(generate_series(0, len(ts))) AS d FROM b)),
g AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, max(n) = d AS leaf,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends,
             CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[d].x, {_W})) END AS saved FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM g WHERE d > 0 GROUP BY ALL),
s AS (SELECT p[1:i] AS p, sum(leaf::INT) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(generate_series(0, d)) AS i FROM g) GROUP BY ALL)
SELECT g.conv_id, g.d::BIGINT AS depth, u.conv_id AS parent_conv_id, g.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(g.ends) AS ends_sha256
FROM g JOIN s ON s.p = g.p LEFT JOIN k ON k.p = g.p LEFT JOIN g u ON g.d > 0 AND u.d = g.d - 1 AND u.p = g.p[1:g.d - 1]"""

ORACLES["op12_maxscore"] = f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({maxscore.FACTOR} * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, max(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

ORACLES["op13_collocations"] = f"""
WITH d AS (SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang,
                  unnest(string_split_regex(translate(coalesce(text, ''), '{quality.UPPER}', '{quality.LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM d),
i AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w WHERE len(ws) > 0),
n AS (SELECT lang, count(*) AS n FROM i GROUP BY lang),
f AS MATERIALIZED (SELECT lang, ws[i:i + k - 1] AS g, count(*) AS a FROM i, (VALUES (1), (2), (3), (4)) t(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
c AS (SELECT *, unnest(generate_series(1, len(g) - 1)) AS cut FROM f WHERE len(g) > 1),
s AS (SELECT c.lang, c.g, c.a, x.a AS l, y.a AS r, ({collocations.SCALE}::HUGEINT * c.a) // (x.a + y.a) AS score,
             row_number() OVER (PARTITION BY c.lang, c.g ORDER BY ({collocations.SCALE}::HUGEINT * c.a) // (x.a + y.a), cut) AS no
      FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1:len(c.g)]),
z AS (SELECT lang, g[u:u + m - 1] AS g, max(a) AS longer
      FROM (SELECT *, unnest(generate_series(1, 3)) AS u FROM f WHERE len(g) > 2), (VALUES (2), (3)) t(m)
      WHERE m < len(g) AND u + m - 1 <= len(g) GROUP BY ALL),
q AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, array_to_string(s.g, ' ')) AS rank
      FROM s LEFT JOIN z ON z.lang = s.lang AND z.g = s.g WHERE no = 1 AND (longer IS NULL OR 100::HUGEINT * longer < {collocations.COVER}::HUGEINT * s.a))
SELECT q.lang, rank::BIGINT AS rank, array_to_string(g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n::BIGINT AS n, score::BIGINT AS score
FROM q JOIN n USING (lang) WHERE rank <= {collocations.TOP}"""
