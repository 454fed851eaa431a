"""The registered queries that plain SQL can express."""

from __future__ import annotations

from . import license_scan as L
from . import merkle as MK
from . import mixing as M
from . import quality as Q
from . import sharding as S
from .embedding_dedup import THRESHOLD

# --- quality rules ---------------------------------------------------------------

_SCORES = {
    rule: f"CASE WHEN {whole} = 0 THEN 0 ELSE (1000 * {part}) // {whole} END" for rule, (part, whole) in Q.RULES.items()
}

_MEASURED = f"""
docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM docs),
grams AS (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM grams) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT spot) AS n FROM
  (SELECT rid, i AS spot FROM twice UNION ALL SELECT rid, i + 1 FROM twice UNION ALL SELECT rid, i + 2 FROM twice)
  GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT line) AS kinds
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
measured AS (SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n - l.kinds, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines,
    CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
  FROM split LEFT JOIN covered c USING (rid) LEFT JOIN lines l USING (rid)),
based AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM measured)"""

_RISK = Q.RISK / len(Q.RULES)
_CUTOFFS = f"""
agreed AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id
  HAVING min(quality) = max(quality)),
scored AS ({" UNION ALL ".join(
    f"SELECT lang, '{rule}' AS rule, {s} AS score, good, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8' AS held "
    f"FROM based JOIN agreed USING (doc_id) WHERE NOT base_failed"
    for rule, s in _SCORES.items()
)}),
bins AS (SELECT lang, rule, score, count(*) FILTER (good = 1 AND held) AS h, count(*) FILTER (good = 1 AND NOT held) AS g,
    count(*) FILTER (good = 0 AND NOT held) AS b FROM scored GROUP BY ALL),
cumulated AS (SELECT lang, rule, score,
    {", ".join(f"CAST(sum({c}) OVER (PARTITION BY lang, rule ORDER BY score DESC) AS BIGINT) AS {c}_out" for c in "hgb")},
    {", ".join(f"CAST(sum({c}) OVER (PARTITION BY lang, rule) AS BIGINT) AS {c}_all" for c in "hgb")}
  FROM bins),
tested AS (SELECT *, CASE WHEN h_out >= h_all * {_RISK} THEN 1 ELSE
    (SELECT sum(exp(lgamma(h_all + 1) - lgamma(j + 1) - lgamma(h_all - j + 1) + j * ln({_RISK})
      + (h_all - j) * ln(1 - {_RISK}))) FROM (SELECT unnest(range(h_out + 1)) AS j)) END AS tail,
    b_out / nullif(b_all, 0) - {Q.GOOD_WEIGHT} * (g_out / nullif(g_all, 0)) AS gain FROM cumulated),
tests AS (SELECT {len(Q.RULES)} * greatest(1, count(*)) AS n FROM (SELECT DISTINCT lang FROM bins)),
best AS (SELECT lang, rule, max(score) AS score FROM
  (SELECT *, max(gain) OVER (PARTITION BY lang, rule) AS top FROM tested WHERE gain > 0 AND score > 0)
  WHERE gain = top GROUP BY ALL),
strictest AS (SELECT lang, rule, min(score) AS score FROM tested, tests
  WHERE tail * n <= {Q.ERROR_LEVEL} AND score > 0 AND h_all > 0 GROUP BY ALL),
cuts AS (SELECT b.lang, b.rule, greatest(b.score, s.score) AS cut FROM best b JOIN strictest s
  ON b.rule = s.rule AND b.lang IS NOT DISTINCT FROM s.lang)"""

_REJECTED = " OR ".join(
    f"coalesce({s} >= (SELECT max(cut) FROM cuts WHERE rule = '{rule}' AND cuts.lang IS NOT DISTINCT FROM based.lang), FALSE)"
    for rule, s in _SCORES.items()
)

OP10 = f"""WITH {_MEASURED}, {_CUTOFFS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({_REJECTED}) AS kept FROM based"""

# --- mixing ------------------------------------------------------------------------

# Sources by rising size per weight: the capped ones come first, so running sums decide.
_WEIGHT = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(M.WEIGHTS))
OP3 = f"""WITH sized AS (SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
weighted AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(M.WEIGHTS)} {_WEIGHT} END AS w
  FROM sources),
running AS (SELECT *, (SELECT sum(s) FROM sources) AS total,
    coalesce(sum({M.MAX_RATE} * s) OVER before, 0) AS capped, sum(w) OVER rest AS open FROM weighted
  WINDOW before AS (ORDER BY s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT total - capped AS top, open AS bottom FROM running
  WHERE NOT {M.MAX_RATE} * s * open < w * (total - capped) ORDER BY s / w, source NULLS LAST LIMIT 1),
goals AS (SELECT source, s, CAST(CASE WHEN {M.MAX_RATE} * s * bottom < w * top THEN {M.MAX_RATE} * s
    ELSE CAST(w * top AS DOUBLE) / CAST(bottom AS DOUBLE) END AS DOUBLE) AS target FROM weighted, level),
rated AS (SELECT doc_id, size, s, target, CASE WHEN s = 0 THEN 0 ELSE target / s END AS rate,
    CAST('0x' || substr(md5('{M.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT)
      / {float(1 << 48)} AS u
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source)
SELECT doc_id, size, s AS source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rated"""

# --- archives ----------------------------------------------------------------------

# Base32 by groups of five bits of the digest's 160, four hex digits of the padded groups at a time.
_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_QUANTUM = " || ".join(
    f"substr('{_B32}', CAST((q >> {35 - 5 * i}) & 31 AS INTEGER) + 1, 1)".replace("q", "CAST('0x' || substr(h, {at}, 10) AS BIGINT)")
    for i in range(8)
)
OP1 = f"""WITH hashed AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM hashed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  {" || ".join(_QUANTUM.replace("{at}", str(1 + 10 * i)) for i in range(4))} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM firsts"""

# --- shards ------------------------------------------------------------------------

OP4 = f"""WITH hashed AS (SELECT row_number() OVER () AS rid, doc_id,
    CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1,
      {S.BITS // 4}) AS BIGINT)), {S.BITS}, '0') AS bits FROM documents),
paths AS (SELECT rid, doc_id, n_bytes, d, substr(bits, 1, d) AS shard
  FROM (SELECT *, unnest(range({S.BITS + 1})) AS d FROM hashed)),
buckets AS (SELECT *, sum(n_bytes) OVER same AS b, count(*) OVER same AS n FROM paths
  WINDOW same AS (PARTITION BY d, shard)),
fits AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d) AS k FROM buckets WHERE b <= {S.LIMIT_BYTES} OR n = 1)
SELECT doc_id, n_bytes, shard, CAST(d AS INTEGER) AS depth, CAST(b AS BIGINT) AS shard_bytes,
  CAST(n AS BIGINT) AS shard_rows FROM fits WHERE k = 1"""

# --- vectors: every pair ------------------------------------------------------------

OP6 = f"""WITH RECURSIVE rows_ AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings),
parts AS (SELECT rid, unnest(v) AS x FROM rows_),
sound AS (SELECT rid FROM parts GROUP BY rid HAVING count(*) = count(x)
  AND bool_and(coalesce(isfinite(x), FALSE)) AND bool_or(x <> 0)),
good AS (SELECT rows_.* FROM rows_ JOIN sound USING (rid)),
pairs AS (SELECT a.rid AS l, b.rid AS r FROM good a JOIN good b
  ON a.rid < b.rid AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
links AS (SELECT l, r FROM pairs UNION ALL SELECT r, l FROM pairs),
reach AS (SELECT rid, rid AS other FROM rows_ UNION SELECT reach.rid, links.r FROM reach JOIN links ON links.l = reach.other),
degree AS (SELECT l AS rid, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows_ JOIN (SELECT reach.rid, min(o.vec_id) AS component_id FROM reach JOIN rows_ o ON o.rid = reach.other
  GROUP BY reach.rid) USING (rid) LEFT JOIN degree USING (rid)"""

# --- licences -----------------------------------------------------------------------

_KNOWN = L.compiled(L.TEMPLATES)
_TEMPLATES = ", ".join(
    f"({i}, '{t.license}', {len(t.words)}, {len(t.bigrams)}, '{g}')" for i, t in enumerate(_KNOWN) for g in t.bigrams
)
_ANCHORS = ", ".join(f"('{g}', {t}, {at})" for g, spots in L.anchors(_KNOWN).items() for t, at in spots)


def _best_of_overlapping(source: str, target: str, by: str) -> str:
    return f"""{target}_open AS (SELECT *, coalesce(start < max(stop) OVER (PARTITION BY {by} ORDER BY start, stop, license
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS joined FROM {source}),
{target}_runs AS (SELECT *, count(*) FILTER (NOT joined) OVER (PARTITION BY {by} ORDER BY start, stop, license
    ROWS UNBOUNDED PRECEDING) AS run FROM {target}_open),
{target} AS (SELECT * EXCLUDE (joined, run) FROM {target}_runs
  QUALIFY row_number() OVER (PARTITION BY {by}, run ORDER BY dice DESC, n_template DESC, template, start) = 1)"""


OP8 = f"""WITH known(template, license, n_words, n_template, bigram) AS (VALUES {_TEMPLATES}),
anchors(bigram, template, place) AS (VALUES {_ANCHORS}),
docs AS (SELECT row_number() OVER () AS rid, doc_id,
    lower(regexp_replace(coalesce(text, ''), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')) AS plain FROM documents),
parted AS (SELECT *, string_split(plain, chr(10)) AS lines, string_split_regex(plain, '\\n *\\n') AS paragraphs,
  regexp_extract_all(plain, '[^ \\n]+') AS words FROM docs),
pairs AS (SELECT rid, i, words[i] || ' ' || words[i + 1] AS bigram FROM (SELECT *, unnest(range(1, len(words))) AS i FROM parted)),
windows AS (SELECT DISTINCT rid, greatest(i - 1 - place, 0) AS start, template FROM pairs JOIN anchors USING (bigram)),
units AS (
  SELECT rid, doc_id, 'line' AS unit, unnest(range(len(lines))) AS start, unnest(lines) AS body, -1 AS only_ FROM parted
  UNION ALL SELECT *, -1 FROM (SELECT rid, doc_id, 'paragraph', unnest(range(len(paragraphs))), unnest(paragraphs) AS body
    FROM parted) WHERE contains(body, chr(10))
  UNION ALL SELECT rid, doc_id, 'document', 0, plain, -1 FROM parted WHERE len(paragraphs) > 1
  UNION ALL SELECT rid, doc_id, 'window', start, array_to_string(words[start + 1:start + n_words], ' '), template
    FROM windows JOIN parted USING (rid) JOIN (SELECT DISTINCT template, n_words FROM known) USING (template)),
worded AS (SELECT *, regexp_extract_all(body, '[^ \\n]+') AS w FROM units),
grams AS (SELECT DISTINCT rid, doc_id, unit, start, only_, w[i] || ' ' || w[i + 1] AS bigram
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM worded)),
sized AS (SELECT *, count(*) OVER (PARTITION BY rid, unit, start, only_) AS n_bigrams FROM grams),
counted AS (SELECT rid, doc_id, unit, start, only_, n_bigrams, license, template, n_words, n_template, count(*) AS shared
  FROM sized JOIN known USING (bigram) WHERE only_ IN (-1, template) GROUP BY ALL),
hits AS (SELECT *, round(2 * shared / (n_bigrams + n_template), 6) AS dice,
    start + CASE WHEN unit = 'window' THEN n_words ELSE 1 END AS stop FROM counted
  WHERE 2 * shared / (n_bigrams + n_template) >= {L.THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY rid, unit, start, only_ ORDER BY dice DESC, n_template DESC, template) = 1),
{_best_of_overlapping("hits", "shifted", "rid, unit, license")},
{_best_of_overlapping("shifted", "best", "rid, unit")}
SELECT doc_id, unit, CAST(start AS INTEGER) AS unit_no, license, CAST(shared AS BIGINT) AS shared,
  CAST(n_bigrams AS INTEGER) AS n_bigrams, CAST(n_template AS INTEGER) AS n_template, CAST(dice AS DOUBLE) AS dice
FROM best"""

# --- Merkle manifest -----------------------------------------------------------------

_FIELD = "coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c=c) for c in MK.FIELDS) + ")"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII expression: each character's code, then eight steps, over one list."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT){', -1' * 8}]))"
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda a, b:
      CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""


def _levels(name: str, start: str) -> str:
    """Nodes of every level up to the last node of each tree; ``n`` is the number of nodes of the level."""
    return f"""{name}(tree, h, number, digest, n) AS ({start}
  UNION ALL SELECT tree, h + 1, number // {MK.FANOUT}, sha256(string_agg(digest, '' ORDER BY number)),
    (any_value(n) + {MK.FANOUT - 1}) // {MK.FANOUT}
  FROM {name} WHERE n > 1 GROUP BY tree, h, number // {MK.FANOUT}),
{name}_runs AS (SELECT tree, h, number // {MK.FANOUT} AS run, list(digest ORDER BY number) AS d FROM {name} WHERE n > 1
  GROUP BY ALL)"""


def _walk(name: str, levels: str, start: str) -> str:
    """Way of each row to the last node: siblings met so far and the digest folded so far."""
    left, right = "array_to_string(d[1:k % {f}], '')", "array_to_string(d[k % {f} + 2:], '')"
    left, right = left.format(f=MK.FANOUT), right.format(f=MK.FANOUT)
    return f"""{name}(rid, tree, h, k, met, folded) AS ({start}
  UNION ALL SELECT rid, w.tree, w.h + 1, k // {MK.FANOUT}, met || {left} || {right}, sha256({left} || folded || {right})
  FROM {name} w JOIN {levels}_runs r ON r.tree = w.tree AND r.h = w.h AND r.run = w.k // {MK.FANOUT}),
{name}_end AS (SELECT rid, tree, met, folded FROM (SELECT *, max(h) OVER (PARTITION BY rid) AS last FROM {name}) WHERE h = last)"""


_TAMPERED = _LEAF.replace("CAST(text AS VARCHAR)", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
OP12 = f"""WITH RECURSIVE leaves AS (SELECT row_number() OVER () AS rid, doc_id, source, {_LEAF} AS leaf,
    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_TAMPERED} ELSE {_LEAF} END AS given FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS number,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves),
{_levels("low", "SELECT tree, 0, number, leaf, n FROM numbered")},
tops AS (SELECT tree, digest FROM low WHERE n = 1),
{_levels("high", "SELECT 0, 0, tree, digest, (SELECT count(*) FROM tops) FROM tops")},
{_walk("up", "low", "SELECT rid, tree, 0, number, '', given FROM numbered")},
{_walk("over", "high", "SELECT rid, 0, 0, tree, met, folded FROM up_end")}
SELECT doc_id, leaf, tops.digest AS subroot, root.digest AS root, sha256(o.met) AS proof_sha256,
  o.folded AS folded_root, o.folded = root.digest AS verified
FROM numbered JOIN tops USING (tree) JOIN over_end o USING (rid), (SELECT digest FROM high WHERE n = 1) root"""

# --- prefix trie ----------------------------------------------------------------------

OP13 = f"""WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    {{'role': role, 'text': text}} AS t
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT conv_id, list(t ORDER BY pos) AS s, {crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM turns GROUP BY conv_id),
rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.s[1:o.h], []), o.s[o.h + 1:]) AS s
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
members AS (SELECT conv_id, s[1:d] AS node, len(s) = d AS ends, d FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node),
kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (SELECT nodes.*, coalesce(n, 0) AS n_children,
    (n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(node[depth].text) END AS saved FROM nodes LEFT JOIN kids USING (node)),
below AS (SELECT node[1:d] AS node, n_children, saved FROM (SELECT *, unnest(range(depth + 1)) AS d FROM valued)),
sums AS (SELECT node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY node)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN sums USING (node) LEFT JOIN nodes p ON v.depth > 0 AND p.node = v.node[1:v.depth - 1]"""

ORACLE: dict[str, str] = {
    "op1_warc": OP1,
    "op3_mixing": OP3,
    "op4_sharding": OP4,
    "op6_embedding_dedup": OP6,
    "op8_licenses": OP8,
    "op10_quality_rules": OP10,
    "op12_merkle": OP12,
    "op13_prefix_trie": OP13,
}
