"""DuckDB SQL for the document queries that SQL can express, written from the contracts alone."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op9_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), items AS (SELECT doc_id, unnest(s) AS item FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM items x JOIN items y ON x.item = y.item AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sets sa ON sa.doc_id = a JOIN sets sb ON sb.doc_id = b
  WHERE 100 * n >= 85 * (len(sa.s) + len(sb.s) - n)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other
)
SELECT sets.doc_id, len(s) AS n_shingles, component_id, sets.doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) USING (doc_id)
"""

ORACLE_SQL["op3_mixing"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS hash,
    len(coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])) AS size
  FROM documents
), sources AS (
  SELECT source, source_size, nr, CASE (nr - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nr
        FROM docs GROUP BY source)
), pace(step, p) AS (
  SELECT 0, CAST(sum(source_size) AS DOUBLE) / sum(weight) FROM sources
  UNION ALL
  SELECT step + 1, CAST(sum(source_size) - sum(CASE WHEN 3 * source_size <= weight * p THEN 3 * source_size ELSE 0 END)
      AS DOUBLE) / sum(CASE WHEN 3 * source_size <= weight * p THEN 0 ELSE weight END)
  FROM sources, pace WHERE step < 40 GROUP BY step, p
), targets AS (
  SELECT source, source_size, nr,
    CASE WHEN 3 * source_size <= weight * p THEN CAST(3 * source_size AS DOUBLE) ELSE weight * p END AS target
  FROM sources, (SELECT p FROM pace WHERE step = 40)
), queue AS (
  SELECT d.*, source_size, nr, target,
    sum(size) OVER (PARTITION BY d.source ORDER BY hash, doc_id ROWS UNBOUNDED PRECEDING) AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), items AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY (r * source_size + before) / target, nr, hash, doc_id
                                       ROWS UNBOUNDED PRECEDING) AS total
  FROM queue, range(3) AS rounds(r)
  WHERE size > 0 AND r < least(3, floor(target / source_size) + 1)
), taken AS (
  SELECT doc_id, sum(size) AS taken FROM items
  WHERE total <= (SELECT sum(size) FROM docs) GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queue LEFT JOIN taken USING (doc_id)
"""

ORACLE_SQL["op11_lexical_search"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
), size AS (SELECT doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM size),
postings AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM docs) GROUP BY 1, 2),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM postings, total GROUP BY term, big_n
), lengths AS (SELECT doc_id, 100 - 50 + (50 * n * big_n) // big_l AS m FROM size, total),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY 1, 2
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""


def _repair_step() -> tuple[str, str]:
    """SQL of the cheapest rest of a conversation from one row on, for the four states: without and with insertions before
    the row. A rest is a struct of cost, audit and repaired lines."""
    due, after = "uuau", {"s": 1, "u": 2, "a": 3}
    name = {"u": "user", "a": "assistant"}

    def rest(state: int, of: str, cost: str, edit: str, line: str | None) -> str:
        lines = f"list_prepend({line}, {of}{state}.lines)" if line else f"{of}{state}.lines"
        return f"{{'cost': {of}{state}.cost + {cost}, 'audit': '{edit}' || {of}{state}.audit, 'lines': {lines}}}"

    rows, starts = [], []
    for q in range(4):
        to = after[due[q]]
        choices = [f"[{rest(q, 'v', '2', 'D', None)}]"]
        for letter in due[q] + "s" * (q == 0):
            choices.append(f"CASE WHEN NOT forced AND letter = '{letter}' THEN ["
                           + rest(after[letter], "v", "5 * truncated", "K", "role || ':' || text") + "] ELSE [] END")
        choices.append(f"CASE WHEN NOT forced THEN [{rest(to, 'v', '1 + 5 * truncated', 'R', repr(name[due[q]] + ':') + ' || text')}] ELSE [] END")
        rows.append(f"list_sort({' || '.join(choices)})[1] AS b{q}")
        second = due[to]
        twice = after[second]
        one = rest(to, "b", "5", "I", repr(name[due[q]] + ":"))
        two = (f"{{'cost': b{twice}.cost + 10, 'audit': 'II' || b{twice}.audit, 'lines': "
               f"list_prepend('{name[due[q]]}:', list_prepend('{name[second]}:', b{twice}.lines))}}")
        starts.append(f"list_sort([b{q}, {one}, {two}])[1] AS v{q}")
    return ", ".join(rows), ", ".join(starts)


_ROWS, _STARTS = _repair_step()

ORACLE_SQL["op13_conversation_repair"] = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations
), summed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: list_reduce(
      [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 20 AS what
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
    CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed
), placed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), '') AS c, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i
  FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS letter, NOT regexp_matches(text, '[^ 	-]') AS blank,
    row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
    CAST(NOT regexp_matches(text, '[.!?][ 	-]*$') AS INTEGER) AS truncated,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS letter_before
  FROM placed
), rows_ AS (SELECT *, blank OR again AS forced FROM judged),
walk AS (
  SELECT c, CAST(max(i) + 1 AS BIGINT) AS i, {{'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS v0,
    {{'cost': 10, 'audit': 'II', 'lines': ['user:', 'assistant:']}} AS v1,
    {{'cost': 5, 'audit': 'I', 'lines': ['assistant:']}} AS v2,
    {{'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS v3
  FROM rows_ GROUP BY c
  UNION ALL
  SELECT c, i, {_STARTS} FROM (
    SELECT r.c, r.i, {_ROWS} FROM walk JOIN rows_ r ON r.c = walk.c AND r.i = walk.i - 1)
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (truncated = 1 AND NOT forced) AS truncated,
    count(*) FILTER (i > 1 AND letter_before || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY c
), all_ AS (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS c FROM conversations)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(v0.cost, 0) AS BIGINT) AS cost,
  coalesce(v0.audit, '') AS audit, sha256(coalesce(array_to_string(v0.lines, chr(10)), '')) AS repaired_sha256
FROM all_ LEFT JOIN counts USING (c) LEFT JOIN (SELECT * FROM walk WHERE i = 1) USING (c)
"""
