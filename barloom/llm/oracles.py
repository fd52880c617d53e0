"""SQL for DuckDB of the corpus queries that SQL can express.

Tokenizers, trained models and searches for a best packing cannot be; their tests hold
them against brute force.
"""

from __future__ import annotations

#: The words of a text, and a run of the characters between them.
WORD, GAPS = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]+$"


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, by its polynomial, eight steps a byte."""
    step = "xor(e >> 1, 3988292384 * (e & 1))"
    bits = f"list_reduce(range(8), lambda e, k: {step}, xor(acc, b))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)"
    return f"xor(list_reduce({codes}, lambda acc, b: {bits}, 4294967295::bigint), 4294967295)"


EMBEDDINGS = """
WITH RECURSIVE given AS (
    SELECT row_number() OVER () AS r, vec_id, label,
           list_transform(embedding, lambda x: x::double) AS e
    FROM embeddings),
fine AS (
    SELECT * FROM given
    WHERE label IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.r AS a, b.r AS b
    FROM fine a JOIN fine b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached(r, s) AS (
    SELECT r, r FROM given
    UNION
    SELECT reached.r, links.b FROM reached JOIN links ON reached.s = links.a),
least AS (
    SELECT reached.r, min(other.vec_id) AS component_id
    FROM reached JOIN given other ON reached.s = other.r GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = given.r) AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM given JOIN least USING (r)"""


def _ways() -> str:
    """The least (cost, audit) from each state before a turn, by those after it."""
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    made = {0: 2, 1: 2, 2: 3, 3: 2}
    more = lambda cost, edit, f: f"{{'c': {f}.c + {cost}, 'a': '{edit}' || {f}.a}}"
    raw = []
    for q in range(4):
        options = [more("4", "D", f"f{q}")]
        for initial, after in kept[q].items():
            can = f"usable AND initial = '{initial}'"
            options.append(f"CASE WHEN {can} THEN {more('3 * cut', 'K', f'f{after}')} END")
        again = more("3 + 3 * cut", "R", f"f{made[q]}")
        options.append(f"CASE WHEN usable THEN {again} END")
        raw.append(f"list_min([x FOR x IN [{', '.join(options)}] IF x IS NOT NULL]) AS v{q}")
    return ", ".join(raw)


def _inserted(source: str) -> str:
    """With one insertion, or two, before the turn, where that is less."""
    more = lambda f: f"{{'c': {f}.c + 3, 'a': 'I' || {f}.a}}"
    return f"""
    SELECT cid, i, list_min([v0, {more('w2')}]) AS f0, list_min([v1, {more('w2')}]) AS f1,
           w2 AS f2, w3 AS f3
    FROM (SELECT *, list_min([v2, {more('v3')}]) AS w2, list_min([v3, {more('v2')}]) AS w3
          FROM ({source}))"""


_START = "{'c': 0, 'a': ''}"
_NEVER = "{'c': 1000000, 'a': ''}"

CONVERSATIONS = rf"""
WITH RECURSIVE named AS (
    SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cid, conv_id, turn,
           coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS name
    FROM conversations),
coded AS (SELECT *, {_crc32("name")} % 20 AS code FROM named),
damaged AS (
    SELECT cid, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                ELSE text END AS text, time
    FROM coded, range(1, 3) times(time)
    WHERE code <> 0 AND (time = 1 OR code = 3)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text, time) AS i,
           left(role, 1) AS initial,
           right(regexp_replace(text, '{GAPS}', ''), 1) AS stop
    FROM damaged),
faulty AS (
    SELECT *, CASE WHEN stop = '' THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN stop NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
           lag(initial) OVER (PARTITION BY cid ORDER BY i) AS previous
    FROM placed),
rows AS (
    SELECT *, coalesce(fault IN ('truncated'), false)::int AS cut,
           coalesce(fault = 'truncated', true) AS usable FROM faulty),
facts AS (
    SELECT cid, max(i) AS n,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY cid),
best AS (
    {_inserted(f"SELECT cid, n + 1 AS i, {_START} AS v0, {_NEVER} AS v1, {_NEVER} AS v2, {_START} AS v3 FROM facts")}
    UNION ALL
    {_inserted(f"SELECT best.cid, rows.i, {_ways()} FROM best JOIN rows ON rows.cid = best.cid AND rows.i = best.i - 1")}),
found AS (SELECT cid, f0.c AS cost, f0.a AS audit FROM best WHERE i = 1),
edits AS (
    SELECT cid, p, substr(audit, p, 1) AS edit,
           length(replace(substr(audit, 1, p), 'I', '')) AS i
    FROM found, range(1, 10000) places(p) WHERE p <= length(audit)),
left_in AS (
    SELECT edits.*, rows.role, rows.text, rows.initial,
           row_number() OVER (PARTITION BY edits.cid ORDER BY p) AS place
    FROM edits LEFT JOIN rows ON rows.cid = edits.cid AND rows.i = edits.i
    WHERE edit <> 'D'),
headed AS (
    SELECT *, max((place = 1 AND edit = 'K' AND initial = 's')::int) OVER (PARTITION BY cid) AS head
    FROM left_in),
said AS (
    SELECT cid, string_agg(
        CASE WHEN edit = 'K' THEN role WHEN (place - head) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS said
    FROM headed GROUP BY cid)
SELECT conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank,
       coalesce(duplicate, 0)::bigint AS duplicate, coalesce(truncated, 0)::bigint AS truncated,
       coalesce(illegal, 0)::bigint AS illegal, coalesce(cost, 0)::bigint AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT cid, conv_id FROM named)
LEFT JOIN facts USING (cid) LEFT JOIN found USING (cid) LEFT JOIN said USING (cid)"""

RUNS = rf"""
WITH given AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '{WORD}+') AS words,
           CASE WHEN doc_id IS NOT NULL THEN {_crc32("doc_id::varchar")} END AS h
    FROM documents),
cut AS (SELECT *, len(words) AS n, (h // 10) % greatest(len(words), 1) AS a FROM given),
planned AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM cut),
texts AS (
    SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_concat(words[1:a], list_transform(range(n - a), lambda k: words[a + k % p + 1]))
        ELSE words END AS words
    FROM planned),
tokens AS (
    SELECT r, n, unnest(words) AS w, unnest(range(n)) AS i FROM texts),
equal AS (
    SELECT x.r, x.i, y.i - x.i AS p
    FROM tokens x JOIN tokens y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
    SELECT r, i, p, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM equal),
stretches AS (
    SELECT r, p, min(i) AS start, count(*) + p AS length FROM islands GROUP BY r, p, island),
runs AS (
    SELECT r, start, length, min(p) AS period FROM stretches
    WHERE length >= greatest(6, 4 * p) GROUP BY r, start, length),
listed AS (
    SELECT r, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY r),
best AS (
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::double / period DESC, start, period) = 1),
kept AS (
    SELECT r, string_agg(w, ' ' ORDER BY i) AS kept FROM tokens
    WHERE NOT EXISTS (
        SELECT 1 FROM runs WHERE runs.r = tokens.r
        AND tokens.i >= runs.start + runs.period AND tokens.i < runs.start + runs.length)
    GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::bigint AS n_runs, start::bigint AS start, length::bigint AS length,
       period::bigint AS period, (1000 * length // period)::bigint AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)"""

LLM_ORACLES = {
    "op1_embedding_near_dedup": EMBEDDINGS,
    "op11_conversation_repair": CONVERSATIONS,
    "op12_periodic_runs": RUNS,
}
