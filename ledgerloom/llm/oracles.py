"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import licenses, mixing, url_filter
from .common import LOWER, UPPER, WORD


def _list(values) -> str:
    return "[" + ", ".join("'" + str(v) + "'" for v in values) + "]"


def license_scan() -> str:
    """Places by list slices over all words; votes, lays and phrases as joins."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{licenses.LICENSE_WORD}')"
    vocabulary = _list(licenses._vocabulary(licenses.TEMPLATES, licenses.BASE))
    notices = ", ".join(f"({t}, '{label}', {_list(notice.split())})" for t, (label, notice, _) in enumerate(licenses.TEMPLATES))
    phrases = ", ".join(f"({t}, {_list(p.split())})" for t, (_, _, keys) in enumerate(licenses.TEMPLATES) for p in keys)
    base = ", ".join(f"('{label}', {_list(p.split())})" for p, label in licenses.BASE)
    return f"""
WITH files AS (SELECT row_number() OVER () AS file, doc_id, {words} AS ws FROM documents),
notices(t, label, ns) AS (VALUES {notices}),
phrases(t, ps) AS (VALUES {phrases}),
base(label, ps) AS (VALUES {base}),
hits AS (
  SELECT file, i, ws[i + 1] AS w FROM (SELECT file, ws, unnest(range(len(ws))) AS i FROM files)
  WHERE ws[i + 1] IN (SELECT unnest({vocabulary}))),
idf AS (SELECT w, ln(1 + (SELECT count(*) FROM files) / count(DISTINCT file)) AS idf FROM hits GROUP BY w),
postings AS (SELECT t, p, ns[p + 1] AS w FROM (SELECT t, ns, unnest(range(len(ns))) AS p FROM notices)),
weights AS (
  SELECT t, sum(coalesce(idf, ln(1 + (SELECT count(*) FROM files)))) AS weight FROM postings LEFT JOIN idf USING (w) GROUP BY t),
lays AS (
  SELECT file, t, i - p AS laid, round(sum(idf) / any_value(weight), 6) AS share
  FROM hits JOIN idf USING (w) JOIN postings USING (w) JOIN weights USING (t) GROUP BY file, t, i - p),
stands AS (
  SELECT DISTINCT file, t, laid, share, ps FROM lays JOIN phrases USING (t) JOIN files USING (file) JOIN notices USING (t)
  WHERE share >= {licenses.ENOUGH}
    AND len(list_filter(range(greatest(laid, 0), least(laid + len(ns), len(ws))), lambda i: ws[i + 1 : i + len(ps)] = ps)) > 0),
verified AS (
  SELECT file, t, laid, share FROM stands GROUP BY file, t, laid, share
  HAVING count(*) = (SELECT count(*) FROM phrases p WHERE p.t = stands.t)),
named AS (SELECT file, max(share) AS score, list(DISTINCT label) AS names FROM verified JOIN notices USING (t) GROUP BY file),
places AS (SELECT file, label, i FROM (SELECT file, label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1 : i + len(ps)] = ps)) AS i FROM files, base)),
counted AS (SELECT file, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY file)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(names, [])))), ',') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM files LEFT JOIN counted USING (file) LEFT JOIN named USING (file)"""


JACCARD = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], chr(31)))
                               WHEN len(ws) > 0 THEN [array_to_string(ws, chr(31))] ELSE [] END) AS g FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2) p
  JOIN sizes m ON m.doc_id = p.x JOIN sizes n ON n.doc_id = p.y WHERE 100 * c >= 90 * (m.n + n.n - c)),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""


def url_filtering() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
    long = ", ".join(f"'{s}'" for s in url_filter.LONG_SUFFIXES)
    parts = "://([^/?#]*)([^?#]*)"

    def strength(name: str, children: str) -> str:
        return f"""{name} AS (
  SELECT 1 / least(greatest(CASE WHEN sum((n - 1) * m * (1 - m)) > 0 THEN (sum(n * pow(bad / n - m, 2)) - sum(m * (1 - m))) / sum((n - 1) * m * (1 - m)) ELSE {url_filter.MOST_RHO} END,
    {url_filter.LEAST_RHO}), {url_filter.MOST_RHO}) - 1 AS k FROM {children})"""

    def prior(rate: str, k: str) -> str:
        return f"{rate} - {url_filter.Z} * sqrt({rate} * (1 - {rate}) / ((SELECT k FROM {k}) + 1))"

    bound = f"coalesce(bound, {prior('domains.rate', 'kh')}, {prior('suffixes.rate', 'kd')}, {prior('(SELECT rate FROM rate)', 'ks')})"
    return f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{parts}', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '{parts}', 2) AS path FROM pages),
named AS (
  SELECT *, array_to_string(list_slice(ls, greatest(len(ls) - (CASE WHEN two IN ({long}) THEN 2 ELSE 1 END), 1), len(ls)), '.') AS domain,
    CASE WHEN two IN ({long}) THEN two ELSE ls[len(ls)] END AS suffix
  FROM (SELECT *, array_to_string(list_slice(ls, greatest(len(ls) - 1, 1), len(ls)), '.') AS two FROM (SELECT *, string_split(host, '.') AS ls FROM parts))),
judged AS (SELECT doc_id, CASE WHEN min(quality) = 0 THEN 1 ELSE 0 END AS bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, count(*) AS n, sum(bad) AS bad
  FROM named JOIN judged ON doc_id = TRY_CAST(nullif(regexp_extract(path, '/(\\d{{1,18}})(?:\\.html|/)?$', 1), '') AS BIGINT) GROUP BY host),
rate AS (SELECT CASE WHEN sum(n) IS NULL THEN {url_filter.NO_OUTCOME_RATE} ELSE least(greatest(sum(bad) / sum(n), 0.5 / sum(n)), 1 - 0.5 / sum(n)) END AS rate FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS m FROM hosts, rate GROUP BY suffix),
{strength('ks', 's0')},
suffixes AS (SELECT suffix, (bad + k * m) / (n + k) AS rate FROM s0, ks),
d0 AS (SELECT domain, n, bad, rate AS m FROM (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL) JOIN suffixes USING (suffix)),
{strength('kd', 'd0')},
domains AS (SELECT domain, (bad + k * m) / (n + k) AS rate FROM d0, kd),
h0 AS (SELECT host, n, bad, rate AS m FROM hosts JOIN domains USING (domain)),
{strength('kh', 'h0')},
posterior AS (SELECT host, rate, rate - {url_filter.Z} * sqrt(rate * (1 - rate) / (n + k + 1)) AS bound FROM (SELECT host, n, k, (bad + k * m) / (n + k) AS rate FROM h0, kh)),
rules(own, prefix, say) AS (VALUES {rules}),
fitting AS (
  SELECT page_id, host, path, max_by(own || prefix, length(own || prefix)) AS rule, max_by(say, length(own || prefix)) AS say
  FROM parts JOIN rules ON (host = own OR ends_with(host, '.' || own)) AND starts_with(path, prefix) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(say, CASE WHEN {bound} > {url_filter.BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(p.rate, domains.rate, suffixes.rate, (SELECT rate FROM rate)), 6) AS bad_rate, round({bound}, 6) AS bad_rate_bound
FROM named LEFT JOIN fitting USING (page_id, host, path) LEFT JOIN posterior p USING (host)
LEFT JOIN domains USING (domain) LEFT JOIN suffixes USING (suffix)"""


def mixing_sources() -> str:
    weights = ", ".join(f"{w}.0" for w in mixing.WEIGHTS)
    return f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS code FROM rows GROUP BY source),
capped AS (SELECT *, [{weights}][(code - 1) % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS weight, ({mixing.MAX_PASSES} * source_size)::DOUBLE AS cap FROM per),
levels AS (
  SELECT *, ({mixing.SHARE} * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, code ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, code ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own FROM capped),
level AS (SELECT min_by(own, (cap / weight, code)) AS level FROM levels WHERE own <= cap / weight),
sources AS (
  SELECT source, code, source_size, coalesce(least(cap, level * weight), cap) AS target,
    greatest(ceil(source_size / {mixing.BLOCK_WORDS}), least(source_size, {mixing.MIN_BLOCKS}))::BIGINT AS n_blocks FROM capped, level),
shares AS (
  SELECT *, sum(slots) OVER (ORDER BY code) AS upto, sum(slots) OVER () AS total
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target * n_blocks / source_size ELSE 0 END AS slots FROM sources)),
intervals AS (
  SELECT code, n_blocks, (upto - slots) / total AS lo, CASE WHEN upto >= total * (1 - 1e-12) THEN 2.0 ELSE upto / total END AS hi FROM shares WHERE slots > 0),
points AS (
  SELECT k, (k % {mixing.POINTS}) * {mixing.GOLDEN} % {mixing.POINTS} / {mixing.POINTS}.0::DOUBLE AS u
  FROM (SELECT unnest(range(coalesce((SELECT floor(max(total) + 0.5)::BIGINT FROM shares), 0))) AS k)),
ranked AS (SELECT code, n_blocks, row_number() OVER (PARTITION BY code ORDER BY k) - 1 AS rank FROM points JOIN intervals ON lo <= u AND u < hi),
times AS (SELECT code, rank % n_blocks AS block, count(*) AS times FROM ranked WHERE rank < {mixing.MAX_PASSES} * n_blocks GROUP BY ALL),
placed AS (
  SELECT r, doc_id, size, code, source_size, target, n_blocks,
    sum(size) OVER (PARTITION BY code ORDER BY h, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size AS pos
  FROM rows JOIN sources ON rows.source IS NOT DISTINCT FROM sources.source),
got AS (
  SELECT r, sum(times * (least((block + 1) * source_size // n_blocks, pos + size) - greatest(block * source_size // n_blocks, pos))) AS taken
  FROM placed JOIN times USING (code) WHERE block * source_size // n_blocks < pos + size AND (block + 1) * source_size // n_blocks > pos GROUP BY r)
SELECT doc_id, size, source_size, target::DOUBLE AS target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN got USING (r)"""


_FINITE = "list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x)))"

#: Every anchor against every row.
HARD_NEGATIVES = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND coalesce({_FINITE}, true)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3"""


def merkle_manifest() -> str:
    """Level by level, over all leaves of a source and then over the subroots."""
    def field(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || {column} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if c == "text" else c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"

    def siblings(nodes: str, tree: str) -> str:
        """Of each node with others in its level: the digests left and right of it in its run."""
        return f"""
  SELECT {tree}a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {nodes} a JOIN {nodes} b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.width > 1 GROUP BY ALL"""

    # fixed values: the reversed polynomial of CRC-32 and its mask
    table = "list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
    crc = "xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(d) + 1), lambda i: CAST(ascii(d[i]) AS BIGINT))), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])))"
    return f"""
WITH RECURSIVE crcs AS (
  SELECT doc_id, {crc} AS crc FROM (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS d FROM documents WHERE doc_id IS NOT NULL), (SELECT {table} AS t)),
tampered AS (
  SELECT d.*, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents d LEFT JOIN crcs USING (doc_id)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
    SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '+' || source END AS tree, {leaf("text")} AS leaf, {leaf("cut")} AS cut FROM tampered)),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS width FROM leaves
  UNION ALL (SELECT tree, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), CAST(ceil(width / 3) AS BIGINT)
             FROM nodes WHERE width > 1 GROUP BY tree, level, pos // 3, width)),
subroots AS (SELECT tree, node, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM nodes WHERE width = 1),
tops AS (
  SELECT '' AS tree, 0 AS level, pos, node, count(*) OVER () AS width FROM subroots
  UNION ALL (SELECT tree, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), CAST(ceil(width / 3) AS BIGINT)
             FROM tops WHERE width > 1 GROUP BY tree, level, pos // 3, width)),
inner_siblings AS ({siblings("nodes", "a.tree, ")}),
outer_siblings AS ({siblings("tops", "")}),
folds AS (
  SELECT tree, pos AS leaf_pos, 0 AS level, pos, cut AS node, '' AS proof FROM leaves
  UNION ALL SELECT f.tree, leaf_pos, f.level + 1, f.pos // 3, sha256(l || node || r), proof || l || r
  FROM folds f JOIN inner_siblings s ON f.tree = s.tree AND f.level = s.level AND f.pos = s.pos),
ends AS (
  SELECT f.tree, leaf_pos, s.pos, f.node, proof, s.node AS subroot
  FROM (SELECT * FROM folds QUALIFY row_number() OVER (PARTITION BY tree, leaf_pos ORDER BY level DESC) = 1) f JOIN subroots s USING (tree)),
outer_folds AS (
  SELECT tree, leaf_pos, 0 AS level, pos, node, proof, subroot FROM ends
  UNION ALL SELECT tree, leaf_pos, f.level + 1, f.pos // 3, sha256(l || node || r), proof || l || r, subroot
  FROM outer_folds f JOIN outer_siblings s ON f.level = s.level AND f.pos = s.pos),
folded AS (SELECT * FROM outer_folds QUALIFY row_number() OVER (PARTITION BY tree, leaf_pos ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded.node AS folded_root, folded.node = root AS verified
FROM leaves JOIN folded ON leaves.tree = folded.tree AND leaves.pos = leaf_pos, (SELECT node AS root FROM tops WHERE width = 1)"""


ORACLES = {
    "op2_license_scan": license_scan(),
    "op3_ngram_jaccard_join": JACCARD,
    "op4_url_filter": url_filtering(),
    "op10_mix_sources": mixing_sources(),
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_merkle_manifest": merkle_manifest(),
}
