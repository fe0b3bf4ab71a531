"""The same results in plain SQL over the given tables, where SQL can express them."""

from __future__ import annotations

from dockcast.llm.common import UPPER
from dockcast.llm.license_scan import BASE, signature_rules

_WORD = r"[^\x20\x09-\x0D]+"

_QUALITY = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM texts
),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM parts WHERE len(w) >= 8)
),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(0, 8) AS r(k) GROUP BY doc_id),
measured AS (
  SELECT p.doc_id,
    len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM parts p LEFT JOIN covered c USING (doc_id)
),
failed AS (
  SELECT *,
    (n_words < 20)::BIGINT AS f0, (100 * n_repeat_words > 30 * n_words)::BIGINT AS f1,
    (10 * n_symbols > 3 * n_words)::BIGINT AS f2, (2 * n_dup_lines > n_lines)::BIGINT AS f3,
    (word_chars < 2 * n_words)::BIGINT AS f4, (word_chars > 15 * n_words)::BIGINT AS f5,
    (100 * n_repeat_words > 20 * n_words)::BIGINT AS f6, (10 * n_dup_lines > 3 * n_lines)::BIGINT AS f7,
    (10 * n_symbols > n_words)::BIGINT AS f8
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  f0 + f1 > 0 AS base_failed,
  f0 + f1 + f2 + f3 = 0 AND f4 + f5 + f6 + f7 + f8 < 3 AS kept,
  n_lines,
  f0 + 2 * f1 + 4 * f2 + 8 * f3 + 16 * f4 + 32 * f5 + 64 * f6 + 128 * f7 + 256 * f8 AS failed_bits
FROM failed
"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(0, 2) AS r(k)
),
placed AS (
  SELECT *, row_number() OVER w AS i, coalesce(lag(role) OVER w = role, false) AS goes_on,
    length(text) + len(regexp_extract_all(text, '<\\*\|')) AS escaped
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
),
joined AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS loss,
    sum(escaped + CASE WHEN goes_on THEN length('<|im_sep|>') ELSE length('<|im_start|><|im_end|>') + length(role) + 2 END)::BIGINT AS formatted_chars
  FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM joined
"""

_EXACT = """
SELECT doc_id,
  max(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""



def _license() -> str:
    """The rules are the operator's own table; places, suppression and labels are worked out by SQL."""
    rules = signature_rules()
    keywords = "|".join(sorted({r.keyword for r in rules} | {"licence"}))
    values = ",\n    ".join(f"({i}, '{r.label}', '{r.pattern}', '{r.keyword}', {r.priority}, {r.confidence})" for i, r in enumerate(rules))
    phrases = ", ".join(f"('{label}', ' {'  '.join(p.split())} ')" for p, label in BASE)
    words = "len(regexp_extract_all(x, '[^ ]+'))"
    places = f"""
      coalesce(list_sum(list_transform(list_slice(gaps, 1, k), lambda x: {words})), 0)
      + coalesce(list_sum(list_transform(list_slice(hits, 1, k - 1), lambda x: {words})), 0)"""
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
laid AS (SELECT doc_id, len(w)::BIGINT AS n_words, ' ' || array_to_string(w, '  ') || ' ' AS l FROM words),
gated AS (SELECT doc_id, l FROM laid WHERE regexp_matches(l, ' ({keywords}) ')),
rules(rule, label, pattern, keyword, priority, confidence) AS (VALUES
    {values}
),
phrases(label, pattern) AS (VALUES {phrases}),
base_hits AS (
  SELECT doc_id, label, string_split_regex(l, pattern) AS gaps, regexp_extract_all(l, pattern) AS hits
  FROM gated, phrases WHERE regexp_matches(l, pattern)
),
base AS (SELECT doc_id, label, {places} AS first FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM base_hits)),
rule_hits AS (
  SELECT doc_id, rule, label, priority, confidence, string_split_regex(l, pattern) AS gaps, regexp_extract_all(l, pattern) AS hits
  FROM gated, rules
  WHERE (contains(l, ' ' || keyword || ' ') OR keyword = 'license' AND contains(l, ' licence ')) AND regexp_matches(l, pattern)
),
found AS (
  SELECT doc_id, rule, label, priority, confidence, first, first + n - 1 AS last, n FROM (
    SELECT *, {places} AS first, len(regexp_extract_all(hits[k], '[^ ]+')) AS n FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM rule_hits)
  )
),
stays AS (
  SELECT * FROM found d WHERE NOT EXISTS (
    FROM found o WHERE o.doc_id = d.doc_id AND o.first <= d.first AND o.last >= d.last AND (o.priority, -o.n, o.rule) < (d.priority, -d.n, d.rule)
  )
),
by_base AS (
  SELECT doc_id, count(*)::BIGINT AS n_base, min(first)::BIGINT AS first_word, max(first)::BIGINT AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY doc_id
),
by_rule AS (SELECT doc_id, max(confidence)::DOUBLE AS score FROM stays GROUP BY doc_id),
by_label AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM stays) GROUP BY doc_id
)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM laid LEFT JOIN by_base USING (doc_id) LEFT JOIN by_rule USING (doc_id) LEFT JOIN by_label USING (doc_id)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_SEARCH = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{_TERM}') AS t
  FROM documents
),
total AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM texts WHERE len(t) > 0),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{_TERM}')) AS term
  FROM benchmark
),
held AS (
  SELECT r, doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM texts)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, doc_id, term
),
weighed AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total
),
scored AS (
  SELECT item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weighed USING (term), total GROUP BY item_id, r, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


_ORACLES = {
    "op13_ranked_search": _SEARCH,
    "op2_license_scan": _license(),
    "op1_quality_rules": _QUALITY,
    "op5_chat_formatting": _CHAT,
    "op8_exact_dedup": _EXACT,
}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
