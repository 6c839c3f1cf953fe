"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

from nightshift.llm import licenses
from nightshift.llm.common import ASCII_LOWER, ASCII_UPPER


def _escaped(col: str) -> str:
    return rf"replace(replace({col}, '\', '\\'), '<|', '<\|')"


def chat() -> str:
    probe = "<|im_end|><|im_start|>assistant ok"
    frame = len("<|im_start|>") + len("\n") + len("<|im_end|>") + len("\n")
    role = rf"replace({_escaped('role')}, chr(10), '\n')"
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{probe}'), (-1, 1, 'assistant', '{probe}')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({frame} + length({role}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def license_scan() -> str:
    """The scan as joins of word pairs, with the template table written out."""
    rows = []
    for at, (words, label, phrase, pairs) in enumerate(licenses.templates()):
        rows += [f"({at}, '{label}', {str(phrase).lower()}, {len(words)}, {len(pairs)}, {t}, '{a}', '{b}')" for t, a, b in pairs]
    return f"""
WITH templates(template, label, phrase, length, pairs, t, a, b) AS (VALUES {', '.join(rows)}),
w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'),
         '{licenses.SEPARATORS}'), lambda x: x <> '') AS w
  FROM documents
),
g AS (SELECT doc_id, unnest(range(len(w) - 1)) AS p, unnest(w[:len(w) - 1]) AS a, unnest(w[2:]) AS b FROM w WHERE len(w) > 1),
votes AS (
  SELECT doc_id, template, label, phrase, length, pairs, p - t AS diagonal, t, min(p) AS first_p, max(p) AS last_p
  FROM g JOIN templates USING (a, b) GROUP BY ALL
),
lagged AS (SELECT *, lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS before FROM votes),
marked AS (
  SELECT *, sum(CASE WHEN before IS NULL OR diagonal - before > CASE WHEN phrase THEN 0 ELSE {licenses.GAP} END THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span
  FROM lagged
),
spans AS (
  SELECT doc_id, label, phrase, length, pairs, count(DISTINCT t) / CAST(pairs AS DOUBLE) AS score,
         min(first_p) AS s, max(last_p) + 2 AS e
  FROM marked GROUP BY doc_id, template, label, phrase, length, pairs, span
),
good AS (
  SELECT * FROM spans
  WHERE score >= CASE WHEN phrase THEN 1.0 ELSE {licenses.COVERAGE} END AND e - s <= {licenses.SLACK} * length + {licenses.GAP}
),
found AS (
  SELECT doc_id, count(*) FILTER (WHERE phrase) AS n_base, min(s) FILTER (WHERE phrase) AS first_word,
         max(s) FILTER (WHERE phrase) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM good GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN found USING (doc_id)
"""


def line_dedup() -> str:
    """All pairs of lines that share a shingle, without filters or orders of tokens."""
    return """
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS s FROM docs),
words AS (SELECT doc_id, i, list_filter(string_split(lower(s), ' '), lambda x: x <> '') AS w FROM lines),
long AS (SELECT doc_id, i, array_to_string(w, ' ') AS k, w FROM words WHERE len(w) > 0),
firsts AS (SELECT k, any_value(w) AS w, min((doc_id, i)) AS place FROM long GROUP BY k),
sets AS (
  SELECT k, place, list_distinct(list_transform(range(1, greatest(2, len(w) - 3)), lambda j: array_to_string(w[j:j + 4], ' '))) AS sh
  FROM firsts
),
tokens AS (SELECT k, place, len(sh) AS n, unnest(sh) AS tok FROM sets),
pairs AS (
  SELECT a.k AS k FROM tokens a JOIN tokens b ON a.tok = b.tok AND b.place < a.place
  GROUP BY a.k, b.k, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n)
),
gone AS (
  SELECT doc_id, list(i) AS g FROM long JOIN firsts USING (k)
  WHERE (doc_id, i) > place OR k IN (SELECT k FROM pairs) GROUP BY doc_id
)
SELECT d.doc_id,
       CASE WHEN g IS NULL THEN text
            ELSE array_to_string(list_filter(ls, lambda x, j: NOT list_contains(g, j - 1)), chr(10)) END AS text,
       CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed
FROM docs d LEFT JOIN gone USING (doc_id)
"""


def near_vectors() -> str:
    return """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
usable AS MATERIALIZED (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach(n, m) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.n, l.b FROM reach r JOIN links l ON r.m = l.a),
least AS (SELECT n, min(m) AS c FROM reach GROUP BY n),
degree AS (SELECT a, count(*) AS d FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(d, 0) AS BIGINT) AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN least ON n = vec_id LEFT JOIN degree ON a = vec_id
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; the query must join the one row of ``crc``."""
    byte = "list_transform(range(CAST(length(hex({0})) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(hex({0}), 2 * i + 1, 2) AS BIGINT))".format(text)
    step = "xor(c >> 8, crc_table[1 + (xor(c, b) & 255)])"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, b: {step}), 4294967295)"


#: The table behind ``_crc32``, made from the polynomial.
CRC = """crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table
)"""


def merkle(levels: int = 10, group_levels: int = 3) -> str:
    """The tree level by level; enough levels for 8^levels rows of a language and 8^group_levels languages."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    lowered = f"translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}')"
    parts = [CRC, f"""leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, lang, {leaf('text')} AS d,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(lowered)} END AS t
  FROM documents, crc
)""", """a0 AS MATERIALIZED (
  SELECT lang AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n, d, id FROM leaves
)"""]

    def tree(name: str, count: int) -> None:
        for k in range(count):
            parts.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT g, i // 8 AS i, (max(n) + 7) // 8 AS n, sha256(string_agg(d, '' ORDER BY i)) AS d FROM {name}{k} WHERE n > 1 GROUP BY g, i // 8
)""")
            parts.append(f"""{name}{k}s AS MATERIALIZED (
  SELECT x.g, x.i, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS l,
         coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS r
  FROM {name}{k} x JOIN {name}{k} y ON x.g IS NOT DISTINCT FROM y.g AND x.i // 8 = y.i // 8 WHERE x.n > 1 GROUP BY x.g, x.i
)""")
        whole = " UNION ALL ".join(f"SELECT g, d FROM {name}{k} WHERE n = 1" for k in range(count + 1))
        parts.append(f"{name}top AS MATERIALIZED ({whole})")

    tree("a", levels)
    parts.append("b0 AS MATERIALIZED (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n, d, g AS lang FROM atop)")
    tree("b", group_levels)
    parts.append("p0 AS (SELECT doc_id, lang, leaves.d, coalesce(t, leaves.d) AS c, i, '' AS p FROM leaves JOIN a0 USING (id))")

    def climb(at: int, name: str, k: int, on: str) -> None:
        parts.append(f"""p{at + 1} AS MATERIALIZED (
  SELECT p.* REPLACE (p.i // 8 AS i, CASE WHEN s.l IS NULL THEN p.c ELSE sha256(s.l || p.c || s.r) END AS c,
                      p.p || coalesce(s.l || s.r, '') AS p)
  FROM p{at} p LEFT JOIN {name}{k}s s ON {on} AND s.i = p.i
)""")

    for k in range(levels):
        climb(k, "a", k, "s.g IS NOT DISTINCT FROM p.lang")
    parts.append(f"""p{levels + 1} AS (
  SELECT p.* REPLACE (b.i AS i), b.d AS subroot, (SELECT d FROM btop) AS root
  FROM p{levels} p JOIN b0 b ON b.lang IS NOT DISTINCT FROM p.lang
)""")
    for k in range(group_levels):
        climb(levels + 1 + k, "b", k, "TRUE")
    return f"""
WITH {', '.join(parts)}
SELECT doc_id, d AS leaf, subroot, root, sha256(p) AS proof_sha256, c AS folded_root, c = root AS verified
FROM p{levels + group_levels + 1}
"""


def spelling(min_length: int = 7, min_count: int = 2, ratio: int = 10, slip: int = 31, steps: int = 20) -> str:
    """Near words by patterns: one code point masked (replacement) or taken out (deletion)."""
    return f"""
WITH RECURSIVE {CRC},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{ASCII_UPPER}', '{ASCII_LOWER}') AS run FROM documents
),
hashed AS MATERIALIZED (
  SELECT run, {_crc32("(CAST(doc_id AS VARCHAR) || ':' || run)")} AS h FROM runs, crc WHERE length(run) >= {min_length}
),
slipped AS (
  SELECT CASE WHEN h % {slip} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
),
words AS MATERIALIZED (SELECT word, count(*) AS n FROM slipped WHERE length(word) >= {min_length} GROUP BY word HAVING count(*) >= {min_count}),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
patterns AS MATERIALIZED (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM places),
pairs AS (
  SELECT x.word, y.word AS near, y.n AS m FROM patterns x JOIN patterns y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM patterns x JOIN words y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word, x.n FROM patterns x JOIN words y ON y.word = x.a || x.b
),
best AS (SELECT word, count(*) AS n_near, min((-m, near)) AS first FROM pairs GROUP BY word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -first[1] >= {ratio} * n THEN first[2] END AS form, CASE WHEN -first[1] >= {ratio} * n THEN -first[1] END AS form_n
  FROM words LEFT JOIN best USING (word)
),
chain(word, root, step) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL AND step < {steps}
)
SELECT word, form, root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM formed JOIN (SELECT word, max_by(root, step) AS root FROM chain GROUP BY word) USING (word)
"""


ORACLE_SQL = {
    "op3_license_scans": license_scan(),
    "op6_chat_formatting": chat(),
    "op7_line_dedup": line_dedup(),
    "op8_embedding_near_dedup": near_vectors(),
    "op11_spelling_variants": spelling(),
    "op12_merkle_manifest": merkle(),
}
