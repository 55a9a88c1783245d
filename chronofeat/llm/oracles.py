"""The same results in DuckDB SQL, for operators that SQL can express."""

from __future__ import annotations

from chronofeat.llm.secrets import BASE_RULES, RULES, Rule

#: The given pages have one template: an article element of h1, p, b and br, some of them cut off.
OP1 = r"""
WITH a AS (
  SELECT page_id, url,
         regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS body
  FROM pages
), t AS (
  SELECT page_id, url,
         regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<[^>]*(>|$)', chr(10), 'g') AS plain
  FROM a
), d AS (
  SELECT page_id, url,
         trim(regexp_replace(
           replace(regexp_replace(regexp_replace(plain, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
                   chr(160), ' '),
           '\s+', ' ', 'g')) AS text
  FROM t
)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""

OP4 = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), c AS (
  SELECT *, row_number() OVER w AS place, lag(role) OVER w AS previous FROM given
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), f AS (
  SELECT *,
         CASE WHEN place = 1 THEN role IN ('system', 'user')
              WHEN previous IN ('system', 'assistant') THEN role = 'user'
              WHEN previous = 'user' THEN role = 'assistant'
              ELSE false END AS allowed,
         replace(replace(role, '\', '\\'), '|', '\|') AS role_out,
         replace(replace(text, '\', '\\'), '<|', '<\|') AS text_out,
         CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
       sha256(string_agg(loss, '' ORDER BY place)) AS loss_sha256,
       CAST(sum(length('<|' || role_out || '|>' || chr(10) || text_out || '<|end|>' || chr(10)))
            AS BIGINT) AS formatted_chars,
       bool_and(allowed) AS valid,
       bool_and(allowed) AND last(role ORDER BY place) = 'assistant' AS complete
FROM f GROUP BY conv_id
"""

OP11 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5
"""

OP10 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def _spans(rank: int, rule: Rule) -> str:
    """A list of (start, rank, end, kind): match k starts after k gaps and k - 1 matches."""
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    whole = f"regexp_extract_all(text, {pattern}, 0)"
    part = f"regexp_extract_all(text, {pattern}, {rule.group})"
    gaps = f"string_split_regex(text, {pattern})"

    def chars(items: str, last: str) -> str:
        return f"coalesce(list_sum(list_transform({items}[1:{last}], lambda x: length(x))), 0)"

    start = f"{chars(gaps, 'k')} + {chars(whole, 'k - 1')}"
    span = (
        f"{{'start': CAST({start} AS BIGINT), 'rank': {rank}, "
        f"'stop': CAST({start} + length({whole}[k]) AS BIGINT), 'kind': '{rule.kind}'}}"
    )
    places = (
        f"list_filter(range(1, len({whole}) + 1), lambda k: length({part}[k]) >= {rule.least})"
    )
    return f"list_transform({places}, lambda k: {span})"


def _joined(spans: str) -> str:
    text = "concat_ws(':', s.kind, s.start, s.stop)"
    return f"coalesce(array_to_string(list_transform({spans}, lambda s: {text}), ','), '')"


def _op9() -> str:
    found = "[]"
    for rank, rule in enumerate(RULES):
        found = _spans(rank, rule) if rank == 0 else f"list_concat({found}, {_spans(rank, rule)})"
    base = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
    counts = ",\n       ".join(
        f"len(list_filter(spans, lambda s: s.kind = '{r.kind}')) AS n_{r.kind}" for r in BASE_RULES
    )
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS (SELECT doc_id, list_sort({found}) AS spans FROM t)
SELECT doc_id, {counts},
       sha256({_joined(f"list_filter(spans, lambda s: s.kind IN ({base}))")}) AS base_sha256,
       {_joined("spans")} AS spans
FROM f
"""


LLM_ORACLES = {
    "op1_html_text": OP1,
    "op4_chat_format": OP4,
    "op9_secret_scan": _op9(),
    "op10_exact_dedup": OP10,
    "op11_exact_top_k": OP11,
}
