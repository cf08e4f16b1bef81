"""The SQL of the operators that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from tidemark.llm.quality import STOP_WORDS

_STOP = ", ".join(f"'{word}'" for word in STOP_WORDS)

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM d
), grams AS (
  SELECT rid, i, list_slice(words, i, i + 4) AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w)
), counted AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS times FROM grams
), steps AS (
  SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS step
  FROM counted WHERE times > 1
), repeated AS (
  SELECT rid, sum(step) AS n FROM steps GROUP BY rid
), m AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[ \t\n\x0B\f\r]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words
  FROM w LEFT JOIN repeated USING (rid)
), v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND n_words >= 10 AND n_repeat_words <= n_words * 0.2::DOUBLE
    AND word_chars BETWEEN n_words * 1.5::DOUBLE AND n_words * 25.0::DOUBLE
    AND n_symbols <= n_words * 0.5::DOUBLE AND n_dup_lines <= n_lines * 0.5::DOUBLE
    AND (n_words < 100 OR n_stop_words >= n_words * 0.005::DOUBLE) AS kept
FROM v
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, row_number() OVER talk AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    23
      + length(replace(replace(role, '&', '&amp;'), '<', '&lt;'))
      + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) AS chars
  FROM turns WINDOW talk AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS so_far FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(so_far) FILTER (role = 'assistant' OR pos = n))::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_targets
FROM summed GROUP BY conv_id
"""



def _crc32(text: str) -> str:
    """The unsigned checksum of a short ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT),
      lambda crc, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)),
      4294967295::BIGINT))"""


_WANTED = {1: ("user", 3), 2: ("user", 3), 3: ("assistant", 4), 4: ("user", 3)}
_KEPT = {1: "CASE x.ini WHEN 's' THEN 2 WHEN 'u' THEN 3 END", 2: "CASE x.ini WHEN 'u' THEN 3 END",
         3: "CASE x.ini WHEN 'a' THEN 4 END", 4: "CASE x.ini WHEN 'u' THEN 3 END"}  # fmt: skip


def _best(state: int) -> str:
    """The best edits from a state on, by (cost, letters), of a turn ``x`` before the best of the rest ``z``."""
    role, to = _WANTED[state]
    return f"""list_min(list_filter([
      {{'c': z.best[{state}].c + 2, 'a': 'D' || z.best[{state}].a, 'r': z.best[{state}].r}},
      CASE WHEN NOT x.must AND {_KEPT[state]} IS NOT NULL THEN {{'c': z.best[{_KEPT[state]}].c + x.more,
        'a': 'K' || z.best[{_KEPT[state]}].a, 'r': list_prepend(x.role || ':' || x.text, z.best[{_KEPT[state]}].r)}} END,
      CASE WHEN NOT x.must THEN {{'c': z.best[{to}].c + 1 + x.more,
        'a': 'R' || z.best[{to}].a, 'r': list_prepend('{role}:' || x.text, z.best[{to}].r)}} END
    ], lambda o: o IS NOT NULL))"""


def _inserted(best: str) -> str:
    """Of a list of the best from every state: the best when a turn may be put in first."""
    options = [
        f"list_min([l[{state}], {{'c': l[{to}].c + 5, 'a': 'I' || l[{to}].a, 'r': list_prepend('{role}:', l[{to}].r)}}])"
        for state, (role, to) in _WANTED.items()
    ]
    return f"list_transform([{best}], lambda l: [{', '.join(options)}])[1]"


_TURN = "STRUCT(best STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])[], must BOOLEAN, ini VARCHAR, more BIGINT, role VARCHAR, text VARCHAR)"
_END = """{'best': [{'c': 0, 'a': '', 'r': []}, {'c': 10, 'a': 'II', 'r': ['user:', 'assistant:']},
  {'c': 5, 'a': 'I', 'r': ['assistant:']}, {'c': 0, 'a': '', 'r': []}],
  'must': false, 'ini': '', 'more': 0, 'role': '', 'text': ''}"""
_REPAIRED = _inserted(_inserted(f"[{', '.join(_best(state) for state in _WANTED)}]"))

REPAIR = rf"""
WITH keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS time FROM keyed)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    regexp_replace(text, '[ 	

]+$', '') AS said
  FROM damaged
), marked AS (
  SELECT *, CASE WHEN regexp_full_match(said, '[ 	

]*') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), summed AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal,
    list_reduce(
      list({{'best': NULL, 'must': fault IN ('blank', 'duplicate'), 'ini': ini, 'more': CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END,
        'role': role, 'text': text}}::{_TURN} ORDER BY pos DESC),
      lambda z, x: {{'best': {_REPAIRED}, 'must': false, 'ini': '', 'more': 0, 'role': '', 'text': ''}}::{_TURN},
      {_END}::{_TURN}).best[1] AS best
  FROM marked GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN summed AS s ON o.conv_id IS NOT DISTINCT FROM s.conv_id
"""

_ROLE, _SAYS = "coalesce(role, '')", "coalesce(text, '')"
TRIE = rf"""
WITH turns AS (
  SELECT conv_id, k, len(list_filter(regexp_split_to_array(text, '[ 	

]+'), lambda x: x <> '')) AS w,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, k) AS pos
  FROM (SELECT conv_id, turn, {_ROLE} AS role, {_SAYS} AS text,
      sha256(length({_ROLE}) || ':' || {_ROLE} || {_SAYS}) AS k
    FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("conv_id::VARCHAR")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT conv_id, k, w, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d FROM (
    SELECT c.conv_id, 0 AS part, t.pos, t.k, t.w FROM convs AS c JOIN turns AS t ON t.conv_id = c.base AND t.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1 AS part, t.pos, t.k, t.w FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND t.pos > c.h)
), members AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS w FROM convs
  UNION ALL
  SELECT conv_id, d, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d), w FROM rebuilt
), nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM members GROUP BY path
), kids AS (
  SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT left(path, 64 * up) AS path, sum((n_convs - 1) * w) AS saved, count(*) FILTER (leaf) AS leaves
  FROM (SELECT n.*, k.n IS NULL AS leaf, unnest(range(depth + 1)) AS up FROM nodes AS n LEFT JOIN kids AS k USING (path))
  GROUP BY 1
), ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha FROM (
    SELECT conv_id, path FROM members QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1)
  GROUP BY path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
  b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes AS n JOIN below AS b USING (path) LEFT JOIN kids AS k USING (path) LEFT JOIN ends AS e USING (path)
LEFT JOIN nodes AS p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))
"""

TOP_K = """
WITH rows AS (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.uid, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM rows AS q JOIN rows AS c ON q.vec_id % 20 = 0 AND q.uid <> c.uid
)
SELECT query_id, row_number() OVER best::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY rank <= 20
"""

ORACLES = {
    "op4_chat": CHAT,
    "op9_quality": QUALITY,
    "op11_repair": REPAIR,
    "op12_trie": TRIE,
    "op13_topk": TOP_K,
}
