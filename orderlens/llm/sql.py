"""SQL for an independent engine, for the operators whose result SQL can express."""

from __future__ import annotations

# CRC-32 of a short ASCII text, from its generator polynomial.
CRC32 = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def crc32(text: str) -> str:
    """Expression over a query that also reads crc_table."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
        "lambda c, b: xor(crc_table.t[(xor(c, b) & 255) + 1], c >> 8)))"
    )


def manifest(levels: int = 9, group_levels: int = 3) -> str:
    """Leaf, roots, proof and folded root by one query level after the other, eight nodes to a run.

    Holds up to 8 ** levels rows of a language and 8 ** group_levels languages.
    """

    def leaf(text: str) -> str:
        values = ["doc_id", "source", "lang", "n_chars", text]
        pieces = [f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values]
        return f"sha256({' || '.join(pieces)})"

    def up(name: str, k: int) -> str:
        return f"""
{name}{k + 1} AS (
  SELECT g, p // 8 AS p, (any_value(n) + 7) // 8 AS n,
         CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h
  FROM {name}{k} GROUP BY g, p // 8)"""

    def step(name: str, k: int, have: str) -> tuple[str, str]:
        """Adds the siblings at level k of name to the proof, and folds the digest over them."""
        own = f"{have}_{name}{k}"
        return own, f"""
{own} AS (
  SELECT a.* REPLACE (a.proof || coalesce(s.l, '') || coalesce(s.r, '') AS proof, a.spot // 8 AS spot,
    CASE WHEN s.n = 1 THEN a.f ELSE sha256(coalesce(s.l, '') || a.f || coalesce(s.r, '')) END AS f)
  FROM {have} a JOIN (
    SELECT g, p, n,
      string_agg(h, '') OVER (PARTITION BY g, p // 8 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
      string_agg(h, '') OVER (PARTITION BY g, p // 8 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
    FROM {name}{k}) s ON a.{"g" if name == "a" else "one"} = s.g AND a.spot = s.p)"""

    hit = f"{crc32('doc_id::VARCHAR')} % 3 = 0"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [CRC32, f"""
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf("text")} AS h,
         CASE WHEN {hit} THEN {leaf(lowered)} ELSE {leaf("text")} END AS f
  FROM documents, crc_table)""", """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS spot,
         count(*) OVER (PARTITION BY g) AS n
  FROM leaves)""", "a0 AS (SELECT g, spot AS p, n, h FROM placed)"]  # fmt: skip
    parts += [up("a", k) for k in range(levels)]
    parts.append(f"""
b0 AS (
  SELECT 1 AS g, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n, h, g AS own FROM a{levels})""")
    parts += [up("b", k) for k in range(group_levels)]
    have = "way"
    parts.append("way AS (SELECT doc_id, g, 1 AS one, h, f, spot, '' AS proof FROM placed)")
    for k in range(levels):
        have, text = step("a", k, have)
        parts.append(text)
    parts.append(f"up AS (SELECT w.* REPLACE (b0.p AS spot), b0.h AS subroot FROM {have} w JOIN b0 ON w.g = b0.own)")
    have = "up"
    for k in range(group_levels):
        have, text = step("b", k, have)
        parts.append(text)
    return f"""WITH {",".join(parts)}
SELECT doc_id, w.h AS leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM {have} w, b{group_levels} r"""


def top_k(k: int = 5, every: int = 50, scale: int = 256) -> str:
    """The greatest integer inner products of the vectors whose id is divisible by ``every``."""
    return f"""WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"""


WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def word_repeats(length: int = 35) -> str:
    """Words left when windows of ``length`` words that start elsewhere too are removed."""
    return f"""WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, sha256(array_to_string(w[i:i + {length - 1}], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - {length - 2})) AS i FROM rows)),
again AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, i + unnest(range({length})) AS i FROM windows WHERE h IN (SELECT h FROM again)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM rows),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r),
removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM rows LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)"""


def near_duplicates(words: int = 5, percent: int = 80) -> str:
    """The component of every document under links of similar sets of word shingles."""
    lowered = WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    return f"""WITH RECURSIVE rows AS (SELECT doc_id, {lowered} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {words - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM rows WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= {percent} * (x.n + y.n - shared.n)),
pairs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT pairs.a, reached.c FROM reached JOIN pairs ON pairs.b = reached.doc_id)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM documents d JOIN reached ON reached.doc_id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id GROUP BY d.doc_id"""


def byte_repeats(length: int = 50) -> str:
    """Bytes left when strings of ``length`` bytes that start in an earlier document are removed; bytes as two hex digits."""
    size = 2 * length
    return f"""WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
blocks AS (
  SELECT r, doc_id, base, substr(x, 2 * base + 1, 2 * 500 + {size - 2}) AS x
  FROM (SELECT r, doc_id, x, unnest(range(0, strlen(x) // 2, 500)) AS base FROM rows)),
windows AS (
  SELECT r, doc_id, base + i AS i, md5_number(substr(x, 2 * i + 1, {size})) AS h
  FROM (SELECT r, doc_id, base, x, unnest(range(strlen(x) // 2 - {length - 1})) AS i FROM blocks)),
least AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT r, i + unnest(range({length})) AS i FROM windows JOIN least USING (h) WHERE low < doc_id),
ends AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM gone),
starts AS (SELECT r, i, row_number() OVER (PARTITION BY r ORDER BY i) AS k FROM ends WHERE p IS NULL OR p < i - 1),
stops AS (SELECT r, i + 1 AS e, row_number() OVER (PARTITION BY r ORDER BY i) AS k
  FROM gone WHERE NOT EXISTS (FROM ends WHERE ends.r = gone.r AND ends.p = gone.i AND ends.i = gone.i + 1)),
spans AS (SELECT r, k, i AS s, e FROM starts JOIN stops USING (r, k)),
gaps AS (
  SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY k), 0) AS a, s AS b FROM spans
  UNION ALL SELECT r, max(e), NULL FROM spans GROUP BY r),
kept AS (
  SELECT r, string_agg(substr(x, 2 * a + 1, coalesce(2 * (b - a), strlen(x))), '' ORDER BY a) AS t
  FROM gaps JOIN rows USING (r) GROUP BY r),
counted AS (SELECT r, count(*) AS m, sum(e - s) AS n FROM spans GROUP BY r)
SELECT doc_id, strlen(x)::BIGINT // 2 AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(m, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(t, x))) AS kept_sha256
FROM rows LEFT JOIN kept USING (r) LEFT JOIN counted USING (r)"""
