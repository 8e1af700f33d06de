"""SQL for DuckDB, for the queries that SQL can express."""

from stewardry.llm.merkle import FAN
from stewardry.llm.quality_rules import MAX_HOST_RATE, MAX_REPEAT_PERCENT, MIN_WORDS, RULES

ORACLES: dict[str, str] = {}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_RATES = ", ".join(
    f"""CASE WHEN between_{r} > 0 THEN
    (n_{r} + mean_{r} * greatest(mean_{r} * (1 - mean_{r}) / between_{r} - 1, 0))
    / (n + greatest(mean_{r} * (1 - mean_{r}) / between_{r} - 1, 0))
    ELSE mean_{r} END AS rate_{r}"""
    for r in RULES
)

ORACLES["op4_quality_rules"] = rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda l: length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) > 0) AS lines
  FROM documents),
grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
twice AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS times FROM grams) WHERE times > 1),
repeats AS (SELECT r, sum(least(3, coalesce(next - i, 3))) AS n FROM twice GROUP BY r),
facts AS (
  SELECT doc_id, source, cast(len(w) AS BIGINT) AS n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    cast(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    cast(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM split LEFT JOIN repeats USING (r)),
judged AS (SELECT *, {", ".join(f"({rule}) AS fails_{r}" for r, rule in RULES.items())} FROM facts),
hosts AS (
  SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER (fails_{r}) AS n_{r}" for r in RULES)}
  FROM judged GROUP BY source),
moments AS (
  SELECT count(*) AS hosts, sum(n) AS total,
    {", ".join(f"sum(n_{r}) / sum(n) AS mean_{r}, sum(n_{r} * (n_{r} / n)) / sum(n) AS square_{r}" for r in RULES)} FROM hosts),
spreads AS (
  SELECT *, {", ".join(f"square_{r} - mean_{r} * mean_{r} - mean_{r} * (1 - mean_{r}) * hosts / total AS between_{r}" for r in RULES)}
  FROM moments),
rates AS (SELECT source, {_RATES} FROM hosts, spreads)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT fails_base AND {" AND ".join(f"rate_{r} <= {MAX_HOST_RATE}" for r in RULES)} AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

ORACLES["op9_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, substr(md5('0|' || coalesce(cast(doc_id AS VARCHAR), '')), 1, 16) AS draw,
    cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size
  FROM documents),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized),
sources AS (SELECT source, cast(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w
  FROM sources),
ratios AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS ratio FROM weighted),
tried AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ratios),
found AS (SELECT max(level) AS level FROM tried WHERE level <= ratio),
goals AS (
  SELECT source, source_size, least(cap, coalesce(found.level * w, cap)) AS target FROM tried, found),
parts AS (
  SELECT doc_id, size, source_size, target, before, cast(round(target) AS BIGINT) AS goal,
    CASE WHEN source_size > 0 THEN cast(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM placed JOIN goals ON placed.source IS NOT DISTINCT FROM goals.source)
SELECT doc_id, size, source_size, target,
  cast(epochs * size + greatest(least(goal - epochs * source_size - before, size), 0) AS BIGINT) AS taken
FROM parts
"""

ORACLES["op1_warc_chunks"] = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (SELECT page_id, strlen(body) AS size, sha256(body) AS digest FROM rows),
firsts AS (SELECT digest, min(page_id) AS first FROM digests WHERE size >= 100 GROUP BY digest)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM digests LEFT JOIN firsts USING (digest)
"""

ORACLES["op5_substring_dedup"] = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs)),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (h) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
kept AS (
  SELECT doc_id, count(gone.p) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL), '') AS text
  FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

ORACLES["op3_jaccard_join"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w
  FROM documents),
classes AS (SELECT row_number() OVER () AS c, w, id, n FROM (SELECT w, min(doc_id) AS id, count(*) AS n FROM docs GROUP BY w)),
grams AS (
  SELECT DISTINCT c, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT c, w, unnest(range(1, len(w) - 3)) AS i FROM classes)),
sizes AS (SELECT c, count(*) AS n FROM grams GROUP BY c),
pairs AS (SELECT a.c AS a, b.c AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.c <> b.c GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.c = a JOIN sizes y ON y.c = b WHERE 10 * k >= 8 * (x.n + y.n - k)),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
heads AS (SELECT a AS c, min(id) AS class_id FROM reach JOIN classes ON classes.c = reach.b GROUP BY a),
degrees AS (SELECT a AS c, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, class_id, n - 1 AS n_copies, coalesce(n_links, 0) AS n_links
FROM docs JOIN classes ON docs.w = classes.w JOIN heads USING (c) LEFT JOIN degrees USING (c)
"""

ORACLES["op12_hard_negatives"] = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    cast(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM given a JOIN given b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
near AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  cast(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM near JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def _field(column: str) -> str:
    text = f"cast({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE cast(strlen({text}) AS VARCHAR) || ':' || {text} END"


def _climb(nodes: str, tree: str, levels: int) -> str:
    """Levels above the table ``{nodes}0`` (``tree, i, h``): runs of each, and their digests."""
    out = []
    for k in range(levels):
        out.append(f"""{nodes}{k}_n AS (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {nodes}{k}),
{nodes}{k}_runs AS (SELECT {tree}, i // {FAN} AS run, max(n) AS n, list(h ORDER BY i) AS kids FROM {nodes}{k}_n GROUP BY {tree}, i // {FAN}),
{nodes}{k + 1} AS (
  SELECT {tree}, run AS i, CASE WHEN n = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS h FROM {nodes}{k}_runs),""")
    return "\n".join(out)


def _step(after: str, before: str, runs: str, match: str, size: int) -> str:
    """Fold one level: a row's siblings in its run, unless the level has one node."""
    place = f"(i // {size}) % {FAN}"
    return f"""{after} AS (
  SELECT d.* EXCLUDE (siblings, fold),
    CASE WHEN n = 1 THEN siblings ELSE siblings || array_to_string(kids[1:{place}], '') || array_to_string(kids[{place} + 2:], '') END AS siblings,
    CASE WHEN n = 1 THEN fold
      ELSE sha256(array_to_string(kids[1:{place}], '') || fold || array_to_string(kids[{place} + 2:], '')) END AS fold
  FROM {before} d JOIN {runs} r ON {match} AND r.run = d.i // {size * FAN}),"""


# Levels of a language's tree and of the top tree: room for 8**7 rows of a language.
_LEVELS, _TOPS = 7, 3

ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE bits AS (SELECT n, n AS c, 0 AS k FROM (SELECT unnest(range(256)) AS n) UNION ALL
  SELECT n, xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8),
crcs AS (
  SELECT doc_id, cast(doc_id AS VARCHAR) AS s, 0 AS k, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, crcs.k + 1, xor(crcs.c >> 8, bits.c)
  FROM crcs JOIN bits ON bits.k = 8 AND bits.n = xor(crcs.c, ascii(s[crcs.k + 1])) % 256 WHERE crcs.k < length(s)),
marked AS (SELECT doc_id, xor(c, 4294967295) % 3 = 0 AS tampered FROM crcs WHERE k = length(s)),
leaves AS (
  SELECT doc_id, lang, {" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head, text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, tampered
  FROM documents LEFT JOIN marked USING (doc_id)),
hashed AS (
  SELECT doc_id, lang, {_field("lang")} AS tree, sha256(head || {_field("text")}) AS leaf,
    CASE WHEN tampered THEN sha256(head || {_field("low")}) ELSE sha256(head || {_field("text")}) END AS shown
  FROM leaves),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS i FROM hashed),
node0 AS (SELECT tree, i, leaf AS h FROM placed),
{_climb("node", "tree", _LEVELS)}
langs AS (SELECT DISTINCT tree, lang FROM hashed),
above0 AS (
  SELECT 1 AS one, tree, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, h FROM node{_LEVELS} JOIN langs USING (tree)),
{_climb("above", "one", _TOPS)}
fold0 AS (SELECT *, '' AS siblings, shown AS fold FROM placed),
{chr(10).join(_step(f"fold{k + 1}", f"fold{k}", f"node{k}_runs", "r.tree = d.tree", FAN**k) for k in range(_LEVELS))}
top0 AS (
  SELECT d.doc_id, d.leaf, a.h AS subroot, a.i, d.siblings, d.fold FROM fold{_LEVELS} d JOIN above0 a ON a.tree = d.tree),
{chr(10).join(_step(f"top{k + 1}", f"top{k}", f"above{k}_runs", "r.one = 1", FAN**k) for k in range(_TOPS))}
roots AS (SELECT h AS root FROM above{_TOPS})
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM top{_TOPS}, roots
"""
