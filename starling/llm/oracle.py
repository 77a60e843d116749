"""DuckDB SQL twins of the LLM queries that SQL can express."""

from __future__ import annotations

from starling.llm.license_rules import ALWAYS, KINDS, QUERY_RULES
from starling.llm.thresholds import STOP_WORDS

_STOP = ", ".join(sorted({f"'{f}'" for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())}))

OP8 = f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) >= 3)),
marked AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM marked WHERE n > 1) GROUP BY rid),
counts AS (
  SELECT b.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))::BIGINT AS n_lines,
         len(list_distinct(list_filter(string_split(t, chr(10)),
                                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))))::BIGINT AS n_kinds,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words
  FROM base b LEFT JOIN covered c ON b.rid = c.rid),
rules AS (
  SELECT *, n_lines - n_kinds AS n_dup_lines, greatest(n_words, 1)::DOUBLE AS nw FROM counts),
failed AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
         NOT (word_chars / nw BETWEEN 2.0 AND 15.0) AS f3, n_symbols / nw > 0.1 AS f4,
         n_stop_words / nw < 0.01 AS f5, n_dup_lines / greatest(n_lines, 1)::DOUBLE > 0.5 AS f6 FROM rules)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words,
       f1 OR f2 AS base_failed, NOT (f1 OR f2 OR f3 OR f4 OR f5 OR f6) AS kept,
       concat_ws(',', CASE WHEN f1 THEN 'too_few_words' END, CASE WHEN f2 THEN 'repeated_windows' END,
                 CASE WHEN f3 THEN 'word_length' END, CASE WHEN f4 THEN 'symbols' END,
                 CASE WHEN f5 THEN 'stop_words' END, CASE WHEN f6 THEN 'duplicate_lines' END) AS failed_rules
FROM failed
"""

# unsigned crc32 of a short decimal text, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1),
    lambda i: ascii({0}[i])::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda d, k: xor(d >> 1, 3988292384::BIGINT * (d & 1)))), 4294967295::BIGINT)"""


def _op11(levels: int = 11) -> str:
    """Leaves, levels of nodes one by one, and the fold of every row's siblings."""
    def entry(c):
        return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def leaf(text):
        return "sha256(" + " || ".join([*[entry(c) for c in ("doc_id", "source", "lang", "n_chars")], entry(text)]) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [f"""leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS rank,
         count(*) OVER (PARTITION BY g) AS total
  FROM (SELECT row_number() OVER () AS rid, doc_id, lang AS g, {leaf('text')} AS leaf,
               CASE WHEN {_CRC.format("(doc_id::VARCHAR)")} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS other
        FROM documents)),
a0 AS (SELECT g, rank AS i, leaf AS node, total AS n FROM leaves)"""]

    def up(name, k):
        # nodes of level k + 1; a single node stays the top
        return f"""{name}{k + 1} AS (
  SELECT g, i // 8 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(node, '' ORDER BY i)) ELSE min(node) END AS node,
         (max(n) + 7) // 8 AS n FROM {name}{k} GROUP BY g, i // 8)"""

    for k in range(levels):
        steps.append(up("a", k))
    steps.append(f"tops AS (SELECT g, node AS subroot FROM a{levels})")
    steps.append("b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, subroot AS node, "
                 "count(*) OVER () AS n, g AS name FROM tops)")
    for k in range(levels):
        steps.append(up("b", k))

    def side(name, k):
        # of every node on level k: the nodes of its run before and after it
        same = "PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
        return f"""{name}s{k} AS (
  SELECT g, i, n, coalesce(string_agg(node, '') OVER ({same} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER ({same} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"""

    at = 0
    steps.append("p0 AS (SELECT rid, doc_id, g, leaf, rank AS i, other AS h, '' AS proof FROM leaves)")
    for name, by in (("a", "x.g IS NOT DISTINCT FROM s.g"), ("b", "true")):
        for k in range(levels):
            steps.append(side(name, k))
            steps.append(f"""p{at + 1} AS (
  SELECT x.rid, x.doc_id, x.g, x.leaf, x.i // 8 AS i,
         CASE WHEN s.n > 1 THEN sha256(s.l || x.h || s.r) ELSE x.h END AS h,
         CASE WHEN s.n > 1 THEN x.proof || s.l || s.r ELSE x.proof END AS proof
  FROM p{at} x JOIN {name}s{k} s ON {by} AND x.i = s.i)""")
            at += 1
        if name == "a":
            steps.append(f"""p{at + 1} AS (
  SELECT x.* REPLACE (b.i AS i) FROM p{at} x JOIN b0 b ON x.g IS NOT DISTINCT FROM b.name)""")
            at += 1
    return "WITH " + ",\n".join(steps) + f"""
SELECT p.doc_id, p.leaf, t.subroot, r.node AS root, sha256(p.proof) AS proof_sha256, p.h AS folded_root,
       p.h = r.node AS verified
FROM p{at} p JOIN tops t ON p.g IS NOT DISTINCT FROM t.g CROSS JOIN b{levels} r
"""


def _op13() -> str:
    """Every rule on every text that holds its words; suppression by its definition, pair by pair.

    Words are joined by two spaces here, so that neighbouring matches share none.
    """
    def wide(pattern):
        return pattern.replace(" ?", "(?: )?").replace(" ", "  ").replace("'", "''")

    kinds = list(KINDS)
    rules = ",\n  ".join(f"({i}, {kinds.index(r.kind)}, '{r.label}', '  ({wide(r.pattern)})  ', "
                         + "[" + ", ".join("[" + ", ".join(f"'{w}'" for w in s) + "]" for s in r.required) + "])"
                         for i, r in enumerate(QUERY_RULES))
    base, contract = kinds.index("base"), kinds.index("contract")
    always = ", ".join(str(kinds.index(k)) for k in ALWAYS)
    trust = "[" + ", ".join(str(v) for v in KINDS.values()) + "]"
    return f"""
WITH rules(rule, kind, label, pattern, needs) AS (VALUES
  {rules}),
base AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
tried AS (
  SELECT b.rid, r.*, '  ' || array_to_string(b.w, '  ') || '  ' AS t FROM base b JOIN rules r
  ON len(list_filter(r.needs, lambda s: NOT list_has_any(s, b.w))) = 0),
told AS (
  SELECT *, regexp_extract_all(t, pattern, 1) AS texts,
         string_split(regexp_replace(t, pattern, '  ' || chr(1) || '\\1  ', 'g'), '  ') AS parts FROM tried),
found AS (
  SELECT rid, rule, kind, label, unnest(texts) AS m,
         unnest(list_filter(list_transform(parts, lambda x, i: CASE WHEN starts_with(x, chr(1)) THEN i - 2 END),
                            lambda x: x IS NOT NULL)) AS first
  FROM told WHERE len(texts) > 0),
hits AS (
  SELECT rid, rule, kind, label, first::BIGINT AS first, first + len(string_split(m, '  ')) AS stop FROM found),
standing AS (
  SELECT * FROM hits a WHERE kind IN ({always}) OR NOT EXISTS (
    SELECT 1 FROM hits b WHERE b.rid = a.rid AND (b.rule, b.first) <> (a.rule, a.first) AND (
      (b.first <= a.first AND b.stop >= a.stop AND (b.kind < a.kind OR (b.kind = a.kind AND (
         b.stop - b.first > a.stop - a.first OR b.rule < a.rule))))
      OR (b.first >= a.first AND b.stop <= a.stop AND b.kind < a.kind)))),
totals AS (
  SELECT rid, count(*) FILTER (WHERE kind = {contract}) AS n_base, min(first) FILTER (WHERE kind = {contract}) AS first_word,
         max(first) FILTER (WHERE kind = {contract}) AS last_word,
         list_sort(list_distinct(list(label) FILTER (WHERE kind = {contract}))) AS base_labels,
         count(*) FILTER (WHERE kind = {base}) AS n_phrases, min(first) FILTER (WHERE kind = {base}) AS first_phrase,
         max(first) FILTER (WHERE kind = {base}) AS last_phrase,
         list_sort(list_distinct(list(label) FILTER (WHERE kind = {base}))) AS phrase_labels,
         list_sort(list_distinct(list(label))) AS labels, max({trust}[kind + 1]) AS score
  FROM standing GROUP BY rid)
SELECT b.doc_id, len(b.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       coalesce(array_to_string(labels, ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score,
       coalesce(n_phrases, 0)::BIGINT AS n_phrases, first_phrase, last_phrase,
       coalesce(array_to_string(phrase_labels, ','), '') AS phrase_labels
FROM base b LEFT JOIN totals t ON b.rid = t.rid
"""


ORACLE_SQL: dict[str, str] = {"op8_threshold_rules": OP8, "op11_merkle_rollup": _op11(), "op13_license_rules": _op13()}
