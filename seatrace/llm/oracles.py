"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS cap
  FROM totals),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, coalesce(least(cap, chosen.level * weight), cap) AS target
  FROM levels LEFT JOIN chosen ON true),
drawn AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('mix-1:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
counted AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM drawn)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM counted
"""



RULES = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t),
grams AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM starts),
twice AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, CAST(count(DISTINCT i + k) AS BIGINT) AS n
  FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclamations,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM t LEFT JOIN covered USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 4 * n_words
            OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)
            OR (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))
            OR 10 * n_exclamations > 3 * n_words) AS kept
FROM j
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

CHAT = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text,
      '\', '\\'), '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>'),
      '<|endoftext|>', '<\|endoftext|>'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'),
      '[/INST]', '[\/INST]'), '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>') AS escaped FROM r),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         string_agg('<|im_start|>' || role || chr(10) || escaped || '<|im_end|>' || chr(10), ''
                    ORDER BY turn, role, text) AS formatted,
         string_agg(role || ',', '' ORDER BY turn, role, text) AS roles
  FROM e GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
       CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(length(formatted) AS BIGINT) AS formatted_chars,
       regexp_full_match(roles, '(system,)?(user,assistant,)+') AS valid
FROM g
"""

BYTES = """
WITH t AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM t WHERE length(h) >= 100),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w FROM places),
first AS (SELECT w, min(doc_id) AS d FROM s GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT s.doc_id, s.i FROM s JOIN first USING (w) WHERE first.d < s.doc_id),
islands AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER o <= 50 THEN 0 ELSE 1 END AS opens
            FROM hits WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM islands),
spans AS (SELECT doc_id, n, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, n),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT g.doc_id, count(*) AS o, sum(g.b - g.a) AS r, max(g.b) AS e,
               string_agg(substr(t.h, 2 * before + 1, 2 * (g.a - before)), '' ORDER BY g.a) AS kept
        FROM gaps g JOIN t USING (doc_id) GROUP BY g.doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(o, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(e, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN cut USING (doc_id)
"""

WORDS = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
s AS (SELECT doc_id, i, w[i] AS b, CASE WHEN i + 49 <= len(w) THEN array_to_string(w[i : i + 49], ' ') END AS x FROM places),
first AS (SELECT x, min(doc_id) AS d FROM s WHERE x IS NOT NULL GROUP BY x),
f AS (SELECT s.doc_id, s.i, s.b, coalesce(first.d < s.doc_id, false) AS hit FROM s LEFT JOIN first USING (x)),
c AS (SELECT *, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
g AS (SELECT doc_id, count(*) AS n, count_if(gone) AS r, string_agg(b, ' ' ORDER BY i) FILTER (NOT gone) AS kept
      FROM c GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(r, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN g USING (doc_id)
"""


NEAR_VECTORS = """
WITH RECURSIVE u AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
         coalesce(len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable
  FROM embeddings),
links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM u AS a JOIN u AS b ON a.usable AND b.usable AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (
  SELECT u, v FROM links
  UNION SELECT reach.a, links.v FROM reach JOIN links ON reach.b = links.u),
n AS (SELECT u, count(*) AS n FROM links GROUP BY u),
c AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(c, vec_id) AS component_id,
       coalesce(c, vec_id) = vec_id AS kept
FROM u LEFT JOIN n ON vec_id = n.u LEFT JOIN c ON vec_id = c.a
"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds one after the other, one statement part for each."""
    nearest = """
  SELECT p.vec_id, p.part, arg_min(b.entry, [d, b.entry]) AS entry, min(d) AS d
  FROM parts p JOIN book{round} b USING (part),
       LATERAL (SELECT CAST(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
                AS BIGINT) AS d)
  GROUP BY p.vec_id, p.part"""
    steps = [
        f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {parts} = 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS MATERIALIZED (
  SELECT vec_id, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS x
  FROM v, range({parts}) AS k(part)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < {entries}),
book0 AS MATERIALIZED (SELECT part, entry, x FROM parts JOIN firsts USING (vec_id))"""
    ]
    for r in range(rounds):
        steps.append(
            f"""near{r} AS MATERIALIZED ({nearest.format(round=r)}),
sums{r} AS (
  SELECT part, entry, pos, count(*) AS n, CAST(sum(p.x[pos]) AS BIGINT) AS s
  FROM near{r} JOIN parts p USING (vec_id, part), LATERAL (SELECT unnest(range(1, len(p.x) + 1)) AS pos)
  GROUP BY part, entry, pos),
means{r} AS (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM sums{r} GROUP BY part, entry),
book{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN means{r} m USING (part, entry))"""
        )
    last = f"""near{rounds} AS MATERIALIZED ({nearest.format(round=rounds)}),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (vec_id), digest"""
    return ",\n".join([*steps, last])


def statements() -> dict[str, str]:
    return {
        "op11_vector_codes": vector_codes(),
        "op12_embedding_near_dedup": NEAR_VECTORS,
        "op1_suffix_array_dedup": BYTES,
        "op5_substring_dedup": WORDS,
        "op7_quality_rules": RULES,
        "op8_exact_top_k": TOP_K,
        "op9_chat_format": CHAT,
        "op10_source_mixing": MIXING,
    }
